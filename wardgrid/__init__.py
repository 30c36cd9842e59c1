"""wardgrid: DataFrame operators for subjects, encounters and coded, time-stamped measurements.

Every operator takes DataFrames plus plain parameters and returns a DataFrame (or a Column), so
Catalyst plans the work and nothing runs until an action asks for it.  The few operators that
stage a small intermediate table say so in their docstring.
"""

from wardgrid.session import prepare, staged

__all__ = ["prepare", "staged"]
