"""Dataset descriptions: the only place where column names are written down."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, StringType, StructField, StructType


@dataclass(frozen=True)
class DatasetSpec:
    """What the operators need to know about one table.

    ``missing_tokens`` are the texts that count as a missing cell, ``fill_tokens`` the subset that
    mode imputation replaces.  ``target_type`` is ``"double"`` or ``"string"``; a string target is
    indexed, a numeric one is cast.  ``stream_fields`` maps a training column to the record field
    it is scored from where the two names differ.
    """

    name: str
    target: str
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    missing_tokens: tuple[str, ...] = ("N/A", "")
    fill_tokens: tuple[str, ...] = ("N/A",)
    target_type: str = "double"
    stream_fields: Mapping[str, str] = field(default_factory=dict, hash=False)

    @property
    def inputs(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def columns(self) -> tuple[str, ...]:
        return self.inputs + (self.target,)

    @property
    def indexed(self) -> tuple[str, ...]:
        return tuple(f"{name}_idx" for name in self.categorical)

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.indexed

    def record_field(self, column: str) -> str:
        return self.stream_fields.get(column, column)


# --- Fixed values: column names, targets and ids of the four supported tables -------------------

HEART_NUMERIC = (
    "HighBP", "HighChol", "CholCheck", "BMI", "Smoker", "Stroke", "Diabetes", "PhysActivity",
    "Fruits", "Veggies", "HvyAlcoholConsump", "AnyHealthcare", "NoDocbcCost", "GenHlth",
    "MentHlth", "PhysHlth", "DiffWalk", "Sex", "Age", "Education", "Income",
)

STROKE_CATEGORICAL = ("gender", "ever_married", "work_type", "Residence_type", "smoking_status")
STROKE_NUMERIC = ("age", "hypertension", "heart_disease", "avg_glucose_level", "bmi")

LUNG_NUMERIC = (
    "Age", "Gender", "Air Pollution", "Alcohol use", "Dust Allergy", "OccuPational Hazards",
    "Genetic Risk", "chronic Lung Disease", "Balanced Diet", "Obesity", "Smoking",
    "Passive Smoker", "Chest Pain", "Coughing of Blood", "Fatigue", "Weight Loss",
    "Shortness of Breath", "Wheezing", "Swallowing Difficulty", "Clubbing of Finger Nails",
    "Frequent Cold", "Dry Cough", "Snoring",
)

HEART = DatasetSpec("heart", "HeartDiseaseorAttack", numeric=HEART_NUMERIC)

# Same survey as HEART; the heart outcome takes the place of the diabetes answer.
DIABETES = DatasetSpec(
    "diabetes",
    "Diabetes_binary",
    numeric=tuple(HEART.target if name == "Diabetes" else name for name in HEART_NUMERIC),
)

STROKE = DatasetSpec(
    "stroke",
    "stroke",
    categorical=STROKE_CATEGORICAL,
    numeric=STROKE_NUMERIC,
    drop=("id",),
    stream_fields={"age": "age_stroke", "bmi": "bmi_stroke"},
)

LUNG_CANCER = DatasetSpec(
    "lungcancer",
    "Level",
    numeric=LUNG_NUMERIC,
    drop=("index", "Patient Id"),
    target_type="string",
    stream_fields={
        **{name: name.replace(" ", "_") for name in LUNG_NUMERIC},
        "Gender": "Gender_lung",
        "Smoking": "Smoking_lung",
    },
)

SPECS: dict[str, DatasetSpec] = {s.name: s for s in (HEART, DIABETES, STROKE, LUNG_CANCER)}


@dataclass(frozen=True)
class RecordField:
    """One field of the flat patient record and the values it may take.

    Text fields list their ``choices``.  A numeric field is an integer in ``low..high`` divided by
    ``scale`` (scale 10 gives one decimal).
    """

    name: str
    choices: tuple[str, ...] = ()
    low: int = 0
    high: int = 1
    scale: int = 1


# --- Fixed values: fields of the patient record in order, and their domains -----------------------

RECORD_FIELDS: tuple[RecordField, ...] = (
    RecordField("HighBP", low=0, high=1),
    RecordField("HighChol", low=0, high=1),
    RecordField("CholCheck", low=0, high=1),
    RecordField("BMI", low=150, high=500, scale=10),
    RecordField("Smoker", low=0, high=1),
    RecordField("Stroke", low=0, high=1),
    RecordField("Diabetes", low=0, high=2),
    RecordField("HeartDiseaseorAttack", low=0, high=1),
    RecordField("PhysActivity", low=0, high=1),
    RecordField("Fruits", low=0, high=1),
    RecordField("Veggies", low=0, high=1),
    RecordField("HvyAlcoholConsump", low=0, high=1),
    RecordField("AnyHealthcare", low=0, high=1),
    RecordField("NoDocbcCost", low=0, high=1),
    RecordField("GenHlth", low=1, high=5),
    RecordField("MentHlth", low=0, high=30),
    RecordField("PhysHlth", low=0, high=30),
    RecordField("DiffWalk", low=0, high=1),
    RecordField("Sex", low=0, high=1),
    RecordField("Age", low=1, high=13),
    RecordField("Education", low=1, high=6),
    RecordField("Income", low=1, high=8),
    RecordField("gender", ("Male", "Female")),
    RecordField("age_stroke", low=200, high=850, scale=10),
    RecordField("hypertension", low=0, high=1),
    RecordField("heart_disease", low=0, high=1),
    RecordField("ever_married", ("Yes", "No")),
    RecordField("work_type", ("Private", "Self-employed", "Govt_job", "children")),
    RecordField("Residence_type", ("Urban", "Rural")),
    RecordField("avg_glucose_level", low=5500, high=28000, scale=100),
    RecordField("bmi_stroke", low=150, high=500, scale=10),
    RecordField("smoking_status", ("formerly smoked", "never smoked", "smokes", "Unknown")),
    RecordField("Gender_lung", low=1, high=2),
    RecordField("Air_Pollution", low=1, high=8),
    RecordField("Alcohol_use", low=1, high=8),
    RecordField("Dust_Allergy", low=1, high=8),
    RecordField("OccuPational_Hazards", low=1, high=8),
    RecordField("Genetic_Risk", low=1, high=8),
    RecordField("chronic_Lung_Disease", low=1, high=7),
    RecordField("Balanced_Diet", low=1, high=7),
    RecordField("Obesity", low=1, high=7),
    RecordField("Smoking_lung", low=1, high=8),
    RecordField("Passive_Smoker", low=1, high=8),
    RecordField("Chest_Pain", low=1, high=9),
    RecordField("Coughing_of_Blood", low=1, high=9),
    RecordField("Fatigue", low=1, high=9),
    RecordField("Weight_Loss", low=1, high=8),
    RecordField("Shortness_of_Breath", low=1, high=9),
    RecordField("Wheezing", low=1, high=8),
    RecordField("Swallowing_Difficulty", low=1, high=8),
    RecordField("Clubbing_of_Finger_Nails", low=1, high=9),
    RecordField("Frequent_Cold", low=1, high=7),
    RecordField("Dry_Cough", low=1, high=7),
    RecordField("Snoring", low=1, high=7),
)

RECORD_KEYS = ("patient_id", "timestamp")

RECORD_SCHEMA = StructType(
    [StructField(name, StringType()) for name in RECORD_KEYS]
    + [
        StructField(f.name, StringType() if f.choices else DoubleType())
        for f in RECORD_FIELDS
    ]
)
