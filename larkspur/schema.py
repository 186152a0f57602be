"""Labels, read schemas and the canonical long form ``(key, label, y, score)``."""

from __future__ import annotations

from pyspark.sql import types as T

# The label names and their loss weights, in submission order.
LABELS = [
    "Medical material", "Arterial wall calcification", "Cardiomegaly", "Pericardial effusion",
    "Coronary artery wall calcification", "Hiatal hernia", "Lymphadenopathy", "Emphysema", "Atelectasis",
    "Lung nodule", "Lung opacity", "Pulmonary fibrotic sequela", "Pleural effusion", "Mosaic attenuation pattern",
    "Peribronchial thickening", "Consolidation", "Bronchiectasis", "Interlobular septal thickening",
]
CLASS_WEIGHTS = [
    9.211362733, 2.384068466, 8.295479204, 32.8629776, 2.992233613, 6.064870808, 3.176470588, 4.187083754, 3.022222222,
    1.216071737, 1.677849552, 3.152851834, 7.123261694, 18.16629381, 13.8480647, 6.335045662, 10.81701149, 13.40695067,
]

#: Stand-in labels of the test tables, with the multiplier that makes their scores.
STAND_IN = {"quality": 1, "toxic": 3}

PREDICTION = T.StructType([T.StructField("input_image_name", T.StringType()), T.StructField("probabilities", T.MapType(T.StringType(), T.DoubleType()))])
REPORT = T.StructType([T.StructField("input_image_name", T.StringType()), T.StructField("report", T.StringType())])


def _submission(value: T.StructType) -> T.ArrayType:
    output = T.StructType([T.StructField("value", value)])
    return T.ArrayType(T.StructType([T.StructField("outputs", T.ArrayType(output))]))


PREDICTION_SUBMISSION = _submission(T.StructType([T.StructField("predictions", T.ArrayType(PREDICTION))]))
REPORT_SUBMISSION = _submission(T.StructType([T.StructField("generated_reports", T.ArrayType(REPORT))]))
REPORT_LIST_SUBMISSION = T.ArrayType(T.StructType([T.StructField("outputs", T.ArrayType(T.StructType([T.StructField("value", T.ArrayType(REPORT))])))]))
REPORT_TRUTH = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("generated_reports", T.ArrayType(REPORT))])
VQA = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("image", T.StringType()), T.StructField("conversations", T.ArrayType(T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType()), T.StructField("type", T.StringType())])))]))
