"""Declared schema of every input table; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "time": T.TimestampType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind], True) for name, kind in columns.items()])


TABLES = {
    "PATIENTS": _schema(subject_id="long", gender="string", dob="time", dod="time"),
    "ADMISSIONS": _schema(subject_id="long", hadm_id="long", admittime="time", dischtime="time",
                          admission_type="string", hospital_expire_flag="int"),
    "ICUSTAYS": _schema(subject_id="long", hadm_id="long", icustay_id="long", first_careunit="string",
                        intime="time", outtime="time", los="double"),
    "DIAGNOSES_ICD": _schema(subject_id="long", hadm_id="long", icd9_code="string"),
    "D_ICD_DIAGNOSES": _schema(icd9_code="string", long_title="string"),
    "LABEVENTS": _schema(subject_id="long", hadm_id="long", itemid="long", charttime="time",
                         valuenum="double"),
    "CHARTEVENTS": _schema(subject_id="long", hadm_id="long", icustay_id="long", itemid="long",
                           charttime="time", valuenum="double", error="int"),
    "PRESCRIPTIONS": _schema(subject_id="long", hadm_id="long", drug="string"),
}
