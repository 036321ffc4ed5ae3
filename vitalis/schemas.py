"""Data contracts: fixed values the results depend on, and column tuples.

Everything under "FIXED VALUES" must equal the survey contract for results
to be right; it is written out plainly and in natural order.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (contract of the coded survey and of the training table)
# ---------------------------------------------------------------------------

# Ordered severity classes, least to most severe.
TARGET_ORDER = ("normal", "atencao", "urgente")

# Triage immediacy code -> severity class. Other codes are not eligible.
TARGET_MAP = {1: "urgente", 2: "urgente", 3: "atencao", 4: "normal", 5: "normal"}

# Complaint (reason for visit) code columns, in slot order.
RFV_COLUMNS = ("RFV1", "RFV2", "RFV3", "RFV4", "RFV5")

# Diagnosis code columns present in the EDA cohort.
DIAGNOSIS_COLUMNS = ("DIAG1",)

# Training-table version stamp and split layout: 20 folds, 14 train,
# 3 validation, 3 test.
DATASET_VERSION = "nhamcs-ed-2021-training-v1"
SPLIT_SEED = 42
N_FOLDS = 20
SPLIT_BY_FOLD = ("train",) * 14 + ("validation",) * 3 + ("test",) * 3
SPLIT_NAMES = ("train", "validation", "test")

# Output contract of the training table (all strings, non-null).
TRAINING_COLUMNS = (
    "record_id",
    "clinical_text",
    "target",
    "text_hash",
    "split",
    "dataset_version",
)

# Sentinel ("special") codes per raw field as profiled on the source.
SPECIAL_CODES = {
    "IMMEDR": (-9, -8, 0, 7),
    "AGEDAYS": (-7,),
    "RFV1": (-9,),
    "RFV2": (-9,),
    "RFV3": (-9,),
    "RFV4": (-9,),
    "RFV5": (-9,),
    "TEMPF": (-9,),
    "PULSE": (-9, 998),
    "RESPR": (-9,),
    "BPSYS": (-9,),
    "BPDIAS": (-9, 998),
    "POPCT": (-9,),
    "PAINSCALE": (-9, -8),
}

# Clinical text observation formats, in output order.
OBS_TEMPERATURE = "temperature {} F"
OBS_HEART_RATE = "heart rate {} bpm"
OBS_RESP_RATE = "respiratory rate {}/min"
OBS_BP_BOTH = "blood pressure {}/{} mmHg"
OBS_BP_SYS = "systolic blood pressure {} mmHg"
OBS_BP_DIA = "diastolic blood pressure {} mmHg"
OBS_OXYGEN = "oxygen saturation {}%"
OBS_PAIN = "pain score {}/10"

# Model gate thresholds.
GATE_MIN_F1_MACRO = 0.55
GATE_MIN_URGENT_RECALL = 0.55

# Source-quality gate threshold: share of rows with a primary complaint.
GATE_MIN_PRIMARY_COVERAGE = 0.95

# Text request limits of the scoring contract.
REQUEST_MIN_CHARS = 1
REQUEST_MAX_CHARS = 5000

# Feature-allow/block lists of the EDA contract: post-triage outcome
# columns may be profiled but never become model features.
POST_TRIAGE_COLUMNS = ("DIAG1", "ADMITHOS", "OBSHOS", "ADMIT", "DIEDED")
TRIAGE_FEATURE_COLUMNS = (
    "AGE", "AGEDAYS", "SEX", "RFV1", "RFV2", "RFV3", "RFV4", "RFV5",
    "TEMPF", "PULSE", "RESPR", "BPSYS", "BPDIAS", "POPCT", "PAINSCALE",
)

# Histogram bucket upper bounds of the monitoring series.
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75,
                    1.0, 2.5, 5.0, 7.5, 10.0)
CONFIDENCE_BUCKETS = (0.0, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0)

# Alert rules: threshold, look-back window and hold time.
ALERT_ERROR_INCREASE = 5
ALERT_P95_SECONDS = 1.0
ALERT_MIN_CONFIDENCE = 0.5


@dataclass(frozen=True)
class VitalRule:
    """Cleaning rule of one vital sign."""

    source: str
    clean: str
    label: str
    sentinels: tuple[int, ...]
    lower: int
    upper: int
    scale: int


# Vital rules: source column, cleaned column, label, sentinels, inclusive
# domain and scale divisor.
VITAL_RULES = (
    VitalRule("TEMPF", "temperature_f", "Temperature", (-9,), 600, 1112, 10),
    VitalRule("PULSE", "heart_rate", "Heart rate", (-9, 998), 0, 300, 1),
    VitalRule("RESPR", "respiratory_rate", "Respiratory rate", (-9,), 0, 200, 1),
    VitalRule("BPSYS", "systolic_bp", "Systolic BP", (-9,), 0, 350, 1),
    VitalRule("BPDIAS", "diastolic_bp", "Diastolic BP", (-9, 998), 0, 250, 1),
    VitalRule("POPCT", "oxygen_saturation", "Oxygen saturation", (-9,), 0, 100, 1),
    VitalRule("PAINSCALE", "pain_scale", "Pain scale", (-9, -8), 0, 10, 1),
)

SOURCE_COLUMNS = ("AGE", "AGEDAYS", "SEX", "IMMEDR", *RFV_COLUMNS,
                  *(r.source for r in VITAL_RULES))
