"""Sample sheets, checkpoints, traces and logs: reading, checking, counting and writing them as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import is_nuclear, is_reference, parse_bytes, parse_duration, parse_percent, split_channels, stem, whole_or_null

#: The columns a sheet must have to enter at a step, and the one of them that holds the image.
STEPS = {
    "preprocessing": (["patient_id", "path_to_file", "is_reference", "channels"], "path_to_file"),
    "registration": (["patient_id", "preprocessed_image", "is_reference", "channels"], "preprocessed_image"),
    "segmentation": (["patient_id", "registered_image", "is_reference", "channels"], "registered_image"),
}

#: The columns of checkpoint tables, in order.
CHECKPOINTS = {
    "preprocessed": ["patient_id", "id", "preprocessed_image", "is_reference", "channels", "pixel_size"],
    "registered": ["patient_id", "id", "registered_image", "is_reference", "channels", "pixel_size"],
    "segmented": ["patient_id", "id", "registered_image", "is_reference", "channels", "cell_mask", "nuclei_mask", "contours", "nucleus_contours", "pixel_size"],
    "postprocessed": ["patient_id", "id", "cell_csv", "cell_geojson", "merged_csv", "cell_mask", "pyramid", "pixel_size"],
}

SIZE_LOG = ["process", "sample_id", "filename", "bytes"]


def sheet(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """A CSV table of strings with a header: quotes doubled inside quotes, cells trimmed, blank lines left out.

    A byte-order mark before the first name is dropped.  `row` counts up in the order of the file.
    """
    df = spark.read.options(header=True, sep=separator, quote='"', escape='"', multiLine=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    names = [c.lstrip("﻿").strip() for c in df.columns]
    df = df.toDF(*names).select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in names])
    return df.where(F.concat_ws("", *[F.col(f"`{c}`") for c in names]) != "").withColumn("row", F.monotonically_increasing_id())


def unknown_columns(df: DataFrame, known: list[str]) -> list[str]:
    return [c for c in df.columns if c not in known and c != "row"]


def tagged_sheets(spark: SparkSession, path: str, suffix: str, separator: str = ",") -> DataFrame:
    """`sheet` of many files of one header, such as a plan for each slide, with `source`: the file's name less the suffix, and the row within it."""
    df = spark.read.options(header=True, sep=separator, quote='"', escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1)
    cells = [F.trim(F.col(f"`{c}`")).alias(c.lstrip("\ufeff").strip()) for c in df.columns]
    rows = df.select(F.regexp_replace(name, F.lit(suffix.replace(".", r"\.") + "$"), F.lit("")).alias("source"), *cells, F.monotonically_increasing_id().alias("_id"))
    rows = rows.where(F.concat_ws("", *[F.col(f"`{c}`") for c in rows.columns[1:-1]]) != "")
    return rows.withColumn("row", F.row_number().over(Window.partitionBy("source").orderBy("_id")).cast("long")).drop("_id")  # a file is a sheet


def keyed_documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """key, text of JSON documents, one a file: by their field of that name, else the file's name less its ending; unreadable ones are left out.

    Of several of one key, the last file's.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1)
    raw = spark.read.text(path, wholetext=True).select(name.alias("file"), F.col("value").alias("text"))
    known = raw.where(F.get_json_object("text", "$").isNotNull())
    of = F.coalesce(F.nullif(F.get_json_object("text", f"$.{key}"), F.lit("")), F.regexp_replace("file", r"\.[^.]*$", ""))
    return known.groupBy(of.alias("key")).agg(F.max_by("text", "file").alias("text"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """name, text of files, as they are."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1).alias("name"), F.col("value").alias("text"))


def write_size_log(parts: DataFrame, path: str) -> None:
    """Size logs put together as one CSV table with the log's header; rows are a line a file of a run, so they fit one part."""
    with_columns(parts, SIZE_LOG).select(*SIZE_LOG).orderBy("process", "sample_id", "filename").coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """One row as one JSON document; an error unless there is one row."""
    rows = summary.limit(2).count()
    if rows != 1:
        raise ValueError("a summary is one row")
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def with_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """df; an error that names the required columns it lacks."""
    lacks = [c for c in required if c not in df.columns]
    if lacks:
        raise ValueError(f"missing columns: {', '.join(lacks)}")
    return df


def step_sheet(spark: SparkSession, path: str, step: str) -> DataFrame:
    """A sheet with the columns of a step; an error for unknown steps and missing columns."""
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}; known: {', '.join(STEPS)}")
    return with_columns(sheet(spark, path), STEPS[step][0])


def parsed(rows: DataFrame) -> DataFrame:
    """rows (strings) with is_reference as a boolean and channels as names; an error for other is_reference texts."""
    return rows.withColumns({"is_reference": is_reference(F.col("is_reference")), "channels": split_channels(F.col("channels"))})


def sheet_problems(rows: DataFrame, markers: list[str], allow_none: bool = False) -> DataFrame:
    """patient_id, row, problem of a sheet's rows (strings), and of patients (row NULL) without exactly one reference.

    With `allow_none` a patient may have none.
    """
    flag, names = F.lower(F.trim("is_reference")), split_channels(F.coalesce("channels", F.lit("")))
    broken = {
        "missing patient": F.coalesce(F.trim("patient_id"), F.lit("")) == "",
        "is_reference isn't true or false": ~F.coalesce(flag, F.lit("")).isin("true", "false"),
        "no channels": F.size(names) == 0,
        "no nuclear channel": (F.size(names) > 0) & ~F.exists(names, lambda c: is_nuclear(c, markers)),
    }
    own = rows.select("patient_id", F.col("row").cast("long"), F.explode(F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in broken.items()]), lambda x: x.isNotNull())).alias("problem"))
    refs = rows.where(~broken["missing patient"]).groupBy("patient_id").agg(F.count_if(F.coalesce(flag == "true", F.lit(False))).alias("n"))
    many = F.when(F.col("n") > 1, "several references").when((F.col("n") == 0) & F.lit(not allow_none), "no reference")
    return own.unionByName(refs.select("patient_id", F.lit(None).cast("long").alias("row"), many.alias("problem")).where("problem is not null"))


def checked(rows: DataFrame, markers: list[str], allow_none: bool = False) -> DataFrame:
    """`parsed` rows; an error that names the first problems, if there are any, or that there are no rows."""
    if rows.isEmpty():
        raise ValueError("the sheet has no rows")
    found = sheet_problems(rows, markers, allow_none).orderBy("row", "patient_id", "problem").limit(5).collect()
    if found:
        raise ValueError("; ".join(f"{r['problem']} (patient {r['patient_id']}, row {r['row']})" for r in found))
    return parsed(rows)


def image_counts(rows: DataFrame) -> DataFrame:
    """patient_id, images: rows of each patient that isn't blank."""
    return rows.where("trim(patient_id) <> ''").groupBy("patient_id").agg(F.count("*").alias("images"))


def stem_counts(rows: DataFrame, image: str) -> DataFrame:
    """patient_id, stem, n: rows of a patient with images of one stem."""
    return rows.where("trim(patient_id) <> ''").groupBy("patient_id", stem(F.col(image)).alias("stem")).agg(F.count("*").alias("n"))


def declared_channels(rows: DataFrame) -> DataFrame:
    """patient_id, n: different channel names, whatever the case; rows have channels as arrays."""
    return rows.select("patient_id", F.explode("channels").alias("c")).groupBy("patient_id").agg(F.countDistinct(F.upper("c")).alias("n"))


def reference_channels(rows: DataFrame, order: str) -> DataFrame:
    """patient_id, channels of the patient's last row, in order, that is a reference."""
    return rows.where("is_reference").groupBy("patient_id").agg(F.max_by("channels", order).alias("channels"))


def identities(rows: DataFrame, image: str, order: str) -> DataFrame:
    """rows with id: the image's stem, behind the patient unless it begins so; and _000, _001, ... (the row's place
    among the patient's) where the patient has several images of that stem.
    """
    mine = Window.partitionBy("patient_id")
    name = stem(F.col(image))
    base = F.when(F.startswith(name, F.col("patient_id").cast("string")), name).otherwise(F.concat_ws("_", F.col("patient_id").cast("string"), name))
    many = F.count("*").over(Window.partitionBy("patient_id", name)) > 1
    at = (F.row_number().over(mine.orderBy(order)) - 1).cast("int")
    return rows.withColumn("id", F.when(many, F.concat(base, F.format_string("_%03d", at))).otherwise(base))


def kept_channels(rows: DataFrame, order: str, claimed: DataFrame | None = None) -> DataFrame:
    """patient_id, row (of `order`), channels: those of each slide that no slide before it has, whatever the case; the reference goes first.

    rows (patient_id, is_reference, channels as arrays); `claimed` (patient_id, channel) are taken from the start.
    A slide that keeps none has an empty list.
    """
    each = rows.select("patient_id", order, (~F.col("is_reference")).alias("later"), F.posexplode("channels").alias("at", "channel")).withColumn("name", F.upper("channel"))
    if claimed is not None:
        each = each.join(claimed.select("patient_id", F.upper(F.trim("channel")).alias("name")).distinct(), ["patient_id", "name"], "left_anti")
    first = each.groupBy("patient_id", "name").agg(F.min(F.struct("later", order, "at", "channel")).alias("f"))
    kept = first.groupBy("patient_id", F.col(f"f.{order}").alias(order)).agg(F.transform(F.sort_array(F.collect_list(F.struct("f.at", "f.channel"))), lambda x: x["channel"]).alias("channels"))
    return rows.select("patient_id", order).join(kept, ["patient_id", order], "left").withColumn("channels", F.coalesce("channels", F.array().cast("array<string>")))


def channel_totals(kept: DataFrame) -> DataFrame:
    """patient_id, n: how many channels all slides of a patient keep."""
    return kept.groupBy("patient_id").agg(F.sum(F.size("channels")).cast("long").alias("n"))


def run_manifest(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """patient_id (NULL for all together), images, channels; from one grouping set."""
    both = rows.select("patient_id", F.lit(1).alias("i"), F.lit(0).alias("c")).unionAll(kept.select("patient_id", F.lit(0), F.size("channels")))
    out = both.rollup("patient_id").agg(F.sum("i").alias("images"), F.sum("c").alias("channels"), F.grouping("patient_id").alias("all"))
    return out.where("all = 1 or patient_id is not null").select("patient_id", "images", "channels")


def checkpoint(rows: DataFrame, step: str) -> DataFrame:
    """rows in the columns of a checkpoint, as text; an error for missing and unknown columns."""
    columns = CHECKPOINTS[step]
    with_columns(rows, columns)
    if more := unknown_columns(rows, columns):
        raise ValueError(f"unknown columns: {', '.join(more)}")
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def write_checkpoint(rows: DataFrame, step: str, path: str, level: str = "none") -> bool:
    """Writes a checkpoint as one CSV part, in order, if the clean-up level keeps what it names and there are rows; says if it did.

    A checkpoint has a row a slide; the one task is by nature.
    """
    out = checkpoint(rows, step)
    if level != "none" or out.isEmpty():
        return False
    out.coalesce(1).sortWithinPartitions(*out.columns).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
    return True


def checkpoint_rows(rows: DataFrame, step: str) -> DataFrame:
    """Rows of a checkpoint read as strings, parsed; an error for missing columns, ids or pixel sizes."""
    with_columns(rows, CHECKPOINTS[step])
    known = rows.select("*", F.col("pixel_size").try_cast("double").alias("_size"))
    bad = known.where("coalesce(trim(id), '') = '' or _size is null or not _size > 0").head()
    if bad:
        raise ValueError(f"row without an id or a pixel size: {bad.asDict()}")
    out = known.drop("pixel_size").withColumnRenamed("_size", "pixel_size")
    return parsed(out) if "is_reference" in rows.columns else out


def trace(spark: SparkSession, path: str) -> DataFrame:
    """A trace of tasks (TSV) in numbers: seconds, bytes, percents."""
    return typed_trace(sheet(spark, path, "\t"))


def typed_trace(rows: DataFrame) -> DataFrame:
    """process, tag, name, status, exit and their numbers, of a trace's strings."""
    number = {"realtime_s": ("realtime", parse_duration), "duration_s": ("duration", parse_duration), "cpu_pct": ("%cpu", parse_percent), "cpus": ("cpus", whole_or_null)}
    number |= {f"{c}_b": (c, parse_bytes) for c in ("memory", "peak_rss", "peak_vmem", "rchar", "wchar")}
    return rows.select("process", "tag", "name", "status", "exit", *[f(F.col(f"`{c}`")).alias(k) for k, (c, f) in number.items()])


def size_totals(rows: DataFrame) -> DataFrame:
    """process, sample_id, bytes: sums of a size log; an error unless it has exactly its columns."""
    if [c for c in rows.columns if c != "row"] != SIZE_LOG:
        raise ValueError(f"a size log has the columns {', '.join(SIZE_LOG)}")
    return rows.groupBy("process", "sample_id").agg(F.sum(F.col("bytes").try_cast("long")).alias("bytes"))


def size_log(spark: SparkSession, path: str, process: str, sample: str) -> DataFrame:
    """process, sample_id, filename, bytes of the files at a path, from their metadata; contents aren't read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.lit(process).alias("process"), F.lit(sample).alias("sample_id"), F.regexp_extract("path", r"([^/]*)$", 1).alias("filename"), F.col("length").alias("bytes"))


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, bytes of the files whose names match, in order of their paths."""
    got = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return got.select("path", F.col("length").alias("bytes")).orderBy("path")


def documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one a file, by a declared schema; unreadable ones are left out."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", schema + ", _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("d"))
    return raw.where("d is not null and d._corrupt_record is null").select("d.*").drop("_corrupt_record")


def run_at(step: str, start: str, stop: str, order: Column | list[str] = tuple(STEPS)) -> bool:
    """Whether a step lies between the first and the last one to run."""
    order = list(order)
    return order.index(start) <= order.index(step) <= order.index(stop)
