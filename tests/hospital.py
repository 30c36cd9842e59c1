"""A small hand-made hospital in the declared table layout."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from wardgrid.config import LAB_SIGNALS, VITAL_SIGNALS
from wardgrid.sources.schemas import TABLES

START = datetime(2130, 3, 1, 10)
UNITS = ["MICU", "SICU", " CCU ", None]


def tables(spark, subjects: int = 60, seed: int = 5):
    """Every table as a DataFrame; some subjects have two admissions, no labs, or no diagnoses."""
    rng = random.Random(seed)
    patients, admissions, stays, diagnoses, labs, chart = [], [], [], [], [], []
    for s in range(1, subjects + 1):
        old = s % 13 == 0
        dob = None if s % 29 == 0 else START - timedelta(days=365 * (300 if old else rng.randint(20, 80)))
        patients.append((s, "M" if s % 2 else "F", dob, None))
        for visit in range(2 if s % 4 == 0 else 1):
            hadm = 9000 - 10 * s + visit  # later visits do not have later ids across subjects
            admit = START + timedelta(days=40 * visit + s)
            dead = None if s % 11 == 0 else int(rng.random() < 0.35)
            kind = ["EMERGENCY", "ELECTIVE", "URGENT", None][rng.randint(0, 3)]
            admissions.append((s, hadm, admit, admit + timedelta(days=6), kind, dead))
            los = round(rng.expovariate(0.3), 4)
            stays.append((s, hadm, hadm * 10, UNITS[s % 4], admit, admit + timedelta(days=los), los))
            for _ in range(0 if s % 7 == 0 else rng.randint(1, 4)):
                diagnoses.append((s, hadm, rng.choice(["41071", "4280", "5712", "5722", "V4511", " 042", None, "78099"])))
            if s % 17 == 0:
                continue
            for item in [*LAB_SIGNALS, 50861]:
                for hour in (-2, 0, 5, 24, 30):
                    if rng.random() < 0.7:
                        value = None if rng.random() < 0.1 else round(rng.lognormvariate(1 + (dead or 0), 1.2), 2)
                        labs.append((s, hadm, item, admit + timedelta(hours=hour), value))
            for item in VITAL_SIGNALS:
                for hour in (0, 12, 25):
                    if rng.random() < 0.6:
                        value = round(rng.uniform(90, 104) if item in (678, 223761) else rng.uniform(40, 150), 1)
                        chart.append((s, hadm, hadm * 10, item, admit + timedelta(hours=hour), value, rng.choice([None, 0, 0, 1])))
    titles = [("41071", "Heart attack"), ("4280", "Heart failure")]
    data = {
        "PATIENTS": patients, "ADMISSIONS": admissions, "ICUSTAYS": stays, "DIAGNOSES_ICD": diagnoses,
        "D_ICD_DIAGNOSES": titles, "LABEVENTS": labs, "CHARTEVENTS": chart,
    }
    return {name: spark.createDataFrame(rows, TABLES[name]) for name, rows in data.items()}
