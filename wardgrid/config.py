"""Clinical defaults.  Fixed values: codes, bounds, prefixes and thresholds that results depend on."""

from __future__ import annotations

# Laboratory item codes used for the admission feature matrix, with plausible bounds for clipping.
LAB_SIGNALS = {
    50912: "creatinine",
    51006: "bun",
    51301: "wbc",
    51265: "platelets",
    51222: "hemoglobin",
    50885: "bilirubin",
    50813: "lactate",
}
LAB_BOUNDS = {
    50912: (0, 30),
    51006: (0, 300),
    51301: (0, 200),
    51265: (0, 2000),
    51222: (0, 25),
    50885: (0, 50),
    50813: (0, 30),
}

# Vital signs: every device code, the signal it measures and the signal's plausible bounds.
VITAL_SIGNALS = {
    211: "hr",
    220045: "hr",
    51: "sbp",
    220050: "sbp",
    8368: "dbp",
    220051: "dbp",
    646: "spo2",
    220277: "spo2",
    223761: "temp",
    678: "temp",
    618: "rr",
    220210: "rr",
}
VITAL_BOUNDS = {
    "hr": (0, 300),
    "sbp": (0, 300),
    "dbp": (0, 200),
    "spo2": (50, 100),
    "temp": (25, 45),
    "rr": (0, 80),
}
# Temperature codes recorded in Fahrenheit.  The second tuple is the historic behaviour.
FAHRENHEIT_CODES = (678, 223761)
FAHRENHEIT_CODES_AS_CODED = (678,)

# Markers followed in the cohort story, with their clipping bounds.
STORY_MARKERS = {
    50912: "Creatinine",
    50813: "Lactate",
    51301: "WBC",
    51222: "Hemoglobin",
    50885: "Bilirubin",
    50861: "ALT",
}
STORY_BOUNDS = {
    50912: (0, 20),
    50813: (0, 20),
    51301: (0, 100),
    51222: (0, 20),
    50885: (0, 30),
    50861: (0, 1000),
}
TRAJECTORY_ITEMS = (50912, 50813, 51222)

# Distribution charts: item -> (low, high, bin width); low is excluded.
HISTOGRAM_SPEC = {
    50912: (0, 15, 1.0),
    51301: (0, 50, 2.0),
    51222: (0, 20, 0.5),
}

# Liver signal: item codes, upper limits of normal, multiples that raise the signal.
ITEM_ALT = 50861
ITEM_BILIRUBIN = 50885
ITEM_CREATININE = 50912
ITEM_ALP = 50863
ULN_ALT = 40.0
ULN_BILIRUBIN = 1.2
ALT_MULTIPLE = 3.0
BILIRUBIN_MULTIPLE = 2.0
# A case at this multiple of alkaline phosphatase or more is cholestatic; the limit itself is the usual one for adults.
ULN_ALP = 120.0
ALP_MULTIPLE = 2.0

# Blood toxicity ladders (grade, threshold): the value grades when it lies below the threshold.
BLOOD_MARKERS = {51301: "wbc", 51222: "hgb", 51265: "plt"}
BLOOD_LADDERS = {
    "wbc": [(3, 2.0), (4, 1.0)],
    "hgb": [(3, 8.0), (4, 6.5)],
    "plt": [(3, 50.0), (4, 25.0)],
}

# One-hot lists.
ADMISSION_TYPES = ("EMERGENCY", "ELECTIVE", "URGENT")

# Age: birth dates before the cutoff are shifted records of the very old.
BIRTH_CUTOFF = "1900-01-01"
AGE_SENTINEL = 91.0

# Comorbidity score, fixed values: category -> (weight, ICD-9 prefixes).
COMORBIDITY_TABLE = {
    "MI": (1, ["410", "412"]),
    "CHF": (1, ["428"]),
    "PVD": (1, ["440", "441", "4431", "4432", "4438", "4439", "4471", "5571", "5579", "V434"]),
    "CVD": (1, ["43", "4379"]),
    "Dementia": (1, ["290"]),
    "COPD": (1, ["490", "491", "492", "493", "494", "495", "496",
                 "500", "501", "502", "503", "504", "505"]),
    "Rheumatic": (1, ["4465", "7100", "7101", "7102", "7103", "7104", "7140", "7141", "7142", "7148"]),
    "PUD": (1, ["531", "532", "533", "534"]),
    "MildLiver": (1, ["5712", "5714", "5715", "5716"]),
    "DiabNoComp": (1, ["2500", "2501", "2502", "2503", "2508", "2509"]),
    "DiabComp": (2, ["2504", "2505", "2506", "2507"]),
    "Hemiplegia": (2, ["3341", "342", "343", "3440", "3441", "3442", "3443", "3444", "3445", "3446",
                       "3449"]),
    "Renal": (2, ["582", "5830", "5831", "5832", "5834", "5836", "5837", "585", "586", "5880",
                  "V420", "V451", "V56"]),
    "MalignNoMet": (2, ["140", "141", "142", "143", "144", "145", "146", "147", "148", "149",
                        "150", "151", "152", "153", "154", "155", "156", "157", "158", "159",
                        "160", "161", "162", "163", "164", "165", "170", "171", "172", "174",
                        "175", "176", "179", "180", "181", "182", "183", "184", "185", "186",
                        "187", "188", "189", "190", "191", "192", "193", "194", "195", "200",
                        "201", "202", "203", "204", "205", "206", "207", "208", "2386"]),
    "SevereLiver": (3, ["4560", "4561", "4562", "5722", "5723", "5724", "5725", "5726", "5727",
                        "5728"]),
    "Metastatic": (6, ["196", "197", "198", "199"]),
    "AIDS": (6, ["042", "043", "044"]),
}
# Optional hierarchy: the milder form does not count when the severe form is present.
COMORBIDITY_HIERARCHY = {
    "MildLiver": "SevereLiver",
    "DiabNoComp": "DiabComp",
    "MalignNoMet": "Metastatic",
}
