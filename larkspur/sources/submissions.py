"""Readers of submissions, ground truth and side-car files. Schemas are explicit; malformed input fails the read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur import schema


def first_json(spark: SparkSession, directory: str) -> str:
    """The first JSON file of a directory by name, through Hadoop's file systems; an error if there is none."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(str(x.getPath().toString()) for x in found if x.getPath().getName().endswith(".json"))
    if not names:
        raise FileNotFoundError(f"no JSON file in {directory}")
    return names[0]


def predictions(value: Column) -> Column:
    """Prediction structs of a parsed submission (element 0 of both outer arrays)."""
    return value[0]["outputs"][0]["value"]["predictions"]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(input_image_name, probabilities)."""
    return parse_predictions(spark.read.text(path, wholetext=True))


def parse_predictions(texts: DataFrame) -> DataFrame:
    """S2 over rows of JSON text in ``value``."""
    parsed = texts.select(F.from_json("value", schema.PREDICTION_SUBMISSION, {"mode": "FAILFAST"}).alias("s"))
    return parsed.select(F.explode(predictions(F.col("s"))).alias("p")).select("p.*")


def parse_reports(texts: DataFrame) -> DataFrame:
    """S3: (input_image_name, report); the submission's value is an object or a bare list."""
    as_object = F.from_json("value", schema.REPORT_SUBMISSION)
    as_list = F.from_json("value", schema.REPORT_LIST_SUBMISSION)
    found = F.coalesce(as_object[0]["outputs"][0]["value"]["generated_reports"], as_list[0]["outputs"][0]["value"])
    return texts.select(F.explode(found).alias("r")).select("r.*")


def parse_truth(texts: DataFrame) -> DataFrame:
    """(input_image_name, report) of ground truth."""
    return texts.select(F.explode(F.from_json("value", schema.REPORT_TRUTH, {"mode": "FAILFAST"})["generated_reports"]).alias("r")).select("r.*")


def parse_vqa(texts: DataFrame) -> DataFrame:
    """(id, image, turn, from, value, type), one row for each turn."""
    one = texts.select(F.explode(F.from_json("value", schema.VQA)).alias("c")).select("c.id", "c.image", F.posexplode("c.conversations").alias("turn", "t"))
    return one.select("id", "image", F.col("turn").cast("long"), "t.*")


def read_csv(spark: SparkSession, path: str, ddl: str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """CSV with header; a row cap needs an order to be deterministic."""
    df = spark.read.csv(path, header=True, schema=ddl, mode="FAILFAST", escape='"')
    return df if limit is None else df.orderBy(order or df.columns[0]).limit(limit)


def read_file_list(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Stripped, non-empty names in order."""
    names = spark.read.text(path).select(F.trim("value").alias("name")).where("name <> ''").orderBy("name")
    return names if limit is None else names.limit(limit)


def read_sidecars(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Side-car JSON with the volume's name from the file's."""
    df = spark.read.schema(ddl).option("multiLine", True).json(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return df.select(F.regexp_replace(name, r"_metadata\.json$", "").alias("volume"), "*")


def list_files(spark: SparkSession, directory: str, suffix: str = "*") -> DataFrame:
    """(path, patient, accession, file, length) found recursively; file contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", suffix).load(directory)
    parts = F.split("path", "/")
    return found.select("path", F.try_element_at(parts, F.lit(-3)).alias("patient"), F.try_element_at(parts, F.lit(-2)).alias("accession"), F.element_at(parts, -1).alias("file"), "length")


def label_probabilities(preds: DataFrame, labels: list[str]) -> DataFrame:
    """(key, label, score) of known labels; an absent label scores 0, an unknown one is dropped."""
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.coalesce(F.try_element_at("probabilities", F.lit(x)), F.lit(0.0)).alias("score")) for x in labels]))
    return preds.select(F.col("input_image_name").alias("key"), each.alias("x")).select("key", "x.*")
