"""Constants of the data model. The tables below are fixed values: results depend on them."""

from __future__ import annotations

# Label horizons in calendar months, feature windows in days.
HORIZON_MONTHS = {"3M": 3, "6M": 6, "12M": 12}
HORIZON_DAYS = {"3M": 90, "6M": 180, "12M": 365}

MIN_VALID_YEAR = 1950
DEFAULT_OUTAGE_MINUTES = 120.0
MAX_OUTAGE_MINUTES = 10080.0  # seven days
DEFAULT_CUSTOMERS = 100.0
DEFAULT_CENSORED_DAYS = 1825  # five years

# Expected life in years by class, then by voltage text, then the default.
EXPECTED_LIFE = {
    "Ayırıcı": 25,
    "Kesici": 30,
    "OG/AG Trafo": 30,
    "AG Anahtar": 20,
    "AG Pano Box": 25,
    "Bina": 40,
    "Rekortman": 20,
    "OG Hat": 35,
    "AG Hat": 30,
    "AG Pano": 25,
    "Trafo Bina Tip": 30,
}
EXPECTED_LIFE_BY_VOLTAGE = {"OG": 30, "AG": 25, "YG": 35}
DEFAULT_LIFE = 25

# Spelling variants of a class and the name they are harmonised to.
CLASS_NAMES = {
    "aghat": "AG Hat",
    "AG Hat": "AG Hat",
    "REKORTMAN": "Rekortman",
    "Rekortman": "Rekortman",
    "agdirek": "AG Direk",
    "AG Direk": "AG Direk",
    "OGAGTRF": "OG/AG Trafo",
    "OG/AG Trafo": "OG/AG Trafo",
    "Trafo Bina Tip": "Trafo Bina Tip",
    "SDK": "AG Pano Box",
    "AG Pano": "AG Pano",
    "AG Pano Box": "AG Pano Box",
    "Ayırıcı": "Ayırıcı",
    "anahtar": "AG Anahtar",
    "AG Anahtar": "AG Anahtar",
    "KESİCİ": "Kesici",
    "Kesici": "Kesici",
    "OGHAT": "OG Hat",
    "PANO": "Pano",
    "Bina": "Bina",
    "Armatür": "Armatür",
    "ENHDirek": "ENH Direk",
}

# Suffixes stripped from class text, in order.
CLASS_SUFFIXES = ("Arızaları", "Arızası", "Ariza")

# Districts that count as urban (upper case, both spellings).
URBAN_DISTRICTS = ("SALİHLİ", "ALAŞEHİR", "SALIHLI", "ALAŞEHIR")

# Install dates that are placeholders.
DEFAULT_INSTALL_DATES = ("1978-01-01", "1900-01-01", "1970-01-01")

# Bin edges and labels, right-closed.
AGE_RISK_BINS = ((0.0, 0.4, 0.7, 1.0, float("inf")),
                 ("Low (0-40%)", "Medium (40-70%)", "High (70-100%)", "Critical (>100%)"))
IMPACT_BINS = ((0.0, 1000.0, 5000.0, 20000.0, float("inf")), ("Low", "Medium", "High", "Critical"))
SCORE_BINS = ((0.0, 25.0, 50.0, 75.0, 100.0), ("Low", "Medium", "High", "Critical"))
CHRONIC_BINS = ((0.0, 0.3, 0.5, 0.7, 1.0), ("Low", "Medium", "High", "Critical"))
PROFILE_AGE_BINS = ((0.0, 5.0, 10.0, 20.0, 30.0, 50.0, 1000.0),
                    ("0-5 years", "5-10 years", "10-20 years", "20-30 years", "30-50 years", "50+ years"))
RISK_BINS = ((0.0, 75.0, 90.0, 95.0, 100.0), ("DÜŞÜK", "ORTA", "YÜKSEK", "KRİTİK"))
SURVIVAL_CUTS = ((0.70, "YÜKSEK"), (0.40, "ORTA"))
SURVIVAL_FLOOR = "DÜŞÜK"
RISK_THRESHOLDS = {"3M": 0.40, "6M": 0.50, "12M": 0.60}
ACTIONS = {
    "KRİTİK": "IMMEDIATE REPLACEMENT",
    "YÜKSEK": "PRIORITY REPLACEMENT",
    "ORTA": "PREVENTIVE MAINTENANCE",
    "DÜŞÜK": "ROUTINE MONITORING",
}

# Name fragments that reveal a column built from the future or from the target.
SAFE_FRAGMENTS = ("Toplam_Arıza_Sayısı", "OAZS_", "Onarım_Süresi_", "Ekipman_Yaşı")
LEAKAGE_FRAGMENTS = {
    "temporal_window": ("_3Ay", "_6Ay", "_12Ay", "_3M", "_6M", "_12M"),
    "target_derived": ("Hedef_", "Target_", "Arıza_Olasılığı", "PoF_Probability", "Risk_Sınıfı", "Risk_Class"),
    "target_indicator": ("Tekrarlayan_Arıza", "Recurrence", "AgeRatio_", "Interaction"),
    "aggregation": ("_Cluster_Avg", "_Class_Avg", "_Küme_Ort", "_Sınıf_Ort"),
}
OUTPUT_LEAKAGE_FRAGMENTS = ("Future", "After_Cutoff", "Prediction_Period", "Post_2024", "_Leak", "Target_")

# Report category of a column, first match wins.
CATEGORY_RULES = (
    ("Failure History", ("Arıza", "Fault", "Failure")),
    ("Age/Life", ("Yaş", "Age", "Ömür")),
    ("Geographic", ("KOORDINAT", "Geographic", "Cluster")),
    ("Customer Impact", ("Customer", "Müşteri")),
    ("Risk Metrics", ("Risk", "Score")),
    ("Reliability", ("MTBF", "Reliability")),
    ("Equipment Metadata", ("Ekipman", "Equipment")),
    ("Interaction Features", ("Interaction",)),
)

CORRELATION_LIMIT = 0.85
VIF_TARGET = 10.0
NEAR_CONSTANT_SHARE = 0.99
NEAR_CONSTANT_VARIANCE = 0.001
