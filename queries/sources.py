"""Queries over files: numbered lines of oddly named files, rejected lines, tables by name, counts of whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convspark.params import LineOptions, QaOptions
from convspark.plans.datasets import build_line_dataset, build_qa_dataset
from convspark.sources.comments import read_tables
from convspark.sources.text_lines import read_lines
from convspark.workspace import hadoop_path, new_path
from queries import inputs
from queries.datasets import EXTRA, QA_EXAMPLES_CTE
from queries.registry import query

FOLDERS, FILES = ("north", "south"), 3
#: One base name in every folder, with all that is encoded in a URL.
NAME = "lines %+é #"
# A byte that no UTF-8 text has stands behind some lines.
BROKEN = "id % 11 = 3"


def _renamed(spark: SparkSession, path: str, names: dict[str, str]) -> str:
    """A copy of a partitioned text table as files of given names: partition folder -> name. Some files only."""
    target, filesystem = hadoop_path(spark, path)
    root = new_path(spark, "files")
    for folder, name in names.items():
        source, _ = hadoop_path(spark, f"{path}/{folder}")
        [part] = [s.getPath() for s in filesystem.listStatus(source) if s.getPath().getName().startswith("part-")]
        where, _ = hadoop_path(spark, f"{root}/{name.rpartition('/')[0]}")
        filesystem.mkdirs(where)
        jvm = spark.sparkContext._jvm
        filesystem.rename(part, jvm.org.apache.hadoop.fs.Path(where, name.rpartition("/")[2]))
    return root


def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """Every line of every document in six files: folder by id, three base names that both folders have."""
    documents = inputs.table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % len(FOLDERS)).alias("folder"),
        (F.col("doc_id") % (len(FOLDERS) * FILES)).alias("file"),
        F.col("doc_id").alias("id"),
        "text",
    )
    # one task for each file, and texts move whole
    dealt = documents.repartitionById(len(FOLDERS) * FILES, F.col("file").cast("int"))
    lines = dealt.select("folder", "file", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    broken = F.when(F.expr(BROKEN) & (F.col("pos") == 0), F.concat("line", F.unhex(F.lit("FF")).cast("string"))).otherwise(F.col("line"))
    path = new_path(spark, "line-files")
    ordered = lines.withColumn("line", broken).sortWithinPartitions("folder", "file", "id", "pos")
    ordered.select("folder", "file", "line").write.partitionBy("folder", "file").text(path)
    found = inputs.table(spark, sf_dir, "documents").select((F.col("doc_id") % (len(FOLDERS) * FILES)).alias("k")).distinct()
    files = sorted(r["k"] for r in found.collect())  # six at most
    names = {f"folder={k % len(FOLDERS)}/file={k}": f"{FOLDERS[k % len(FOLDERS)]}/{NAME}{k // len(FOLDERS)}.txt" for k in files}
    return _renamed(spark, path, names)


FILE_LINES_CTE = f"""
split AS (SELECT doc_id AS id, doc_id % {len(FOLDERS)} AS folder, doc_id % {len(FOLDERS) * FILES} AS file,
  unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
file_lines AS (SELECT {list(FOLDERS)}[folder + 1] AS folder, '{NAME}' || (file // {len(FOLDERS)}) || '.txt' AS file_id,
  row_number() OVER (PARTITION BY file ORDER BY id, pos) - 1 AS line_no, line, {BROKEN} AND pos = 0 AS broken FROM split)"""


def _folder(lines: DataFrame) -> DataFrame:
    return lines.withColumn("folder", F.element_at(F.split("path", "/"), -2))


@query(f"WITH {FILE_LINES_CTE} SELECT folder, file_id, line_no, line FROM file_lines WHERE NOT broken")
def numbered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_lines(spark, _line_files(spark, sf_dir) + "/*/lines *")
    return _folder(found.lines).select("folder", "file_id", "line_no", "line")


@query(
    f"""WITH {FILE_LINES_CTE} SELECT folder, file_id, line_no, 'not valid UTF-8' AS reason, hex(encode(line)) || 'FF' AS raw
FROM file_lines WHERE broken"""
)
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table that a job writes beside its set."""
    path = new_path(spark, "set")
    build_line_dataset(spark, _line_files(spark, sf_dir) + "/*/*", path, LineOptions(num_shards_train=4, num_shards_test=2, dataset_format="json"))
    return _folder(spark.read.parquet(path + "-rejects")).select("folder", "file_id", "line_no", "reason", F.hex("raw").alias("raw"))


_JOB_LINES_CTE = f"""
{FILE_LINES_CTE},
clean AS (SELECT * FROM (SELECT folder, file_id, line_no,
  {inputs.clean_line_sql('line')} AS line FROM file_lines WHERE NOT broken) WHERE line <> ''),
previous AS (SELECT file_id, line, lag(line) OVER (PARTITION BY folder, file_id ORDER BY line_no) AS context FROM clean),
made AS (SELECT {inputs.split_label_sql('file_id', 0.9)} AS split FROM previous
         WHERE length(line) BETWEEN 9 AND 127 AND length(context) BETWEEN 9 AND 127)"""


def _as_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(sorted(counts.items()), "name string, n long")


def _counts_sql(counts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS name, ({sql})::BIGINT AS n" for name, sql in counts.items())


_SPLITS = {
    "examples": "SELECT count(*) FROM made",
    "train": "SELECT count(*) FROM made WHERE split = 'train'",
    "test": "SELECT count(*) FROM made WHERE split = 'test'",
}


@query(
    f"WITH {_JOB_LINES_CTE} "
    + _counts_sql(
        {
            "inputs": "SELECT count(*) FROM file_lines",
            "groups": "SELECT count(DISTINCT (folder, file_id)) FROM file_lines",
            "rejects": "SELECT count(*) FROM file_lines WHERE broken",
        }
        | _SPLITS
    )
)
def line_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a whole job counts while it writes a set of records."""
    options = LineOptions(num_extra_contexts=EXTRA, num_shards_train=4, num_shards_test=2)
    return _as_rows(spark, build_line_dataset(spark, _line_files(spark, sf_dir) + "/*/*", new_path(spark, "set"), options))


@query(
    f"""WITH {QA_EXAMPLES_CTE}, made AS (SELECT {inputs.split_label_sql('product_id', 0.9)} AS split FROM qa_examples),
records AS (SELECT conv_id % 50 AS asin FROM conversations GROUP BY conv_id, turn // 4
            UNION ALL SELECT doc_id % 50 FROM documents) """
    + _counts_sql(
        {
            "inputs": "SELECT count(*) FROM records",
            "groups": "SELECT count(DISTINCT asin) FROM records",
            "tuples": f"SELECT count(*) FROM tuples WHERE {inputs.QA_ACCEPTED_SQL}",
            "rejects": "SELECT count(*) FROM region",
        }
        | _SPLITS
    )
)
def qa_job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON lines, with a broken line per region, to a written set."""
    records = inputs.qa_records(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    broken = inputs.table(spark, sf_dir, "region").select(F.concat(F.lit("no record: "), F.col("r_name")).alias("value"))
    path = new_path(spark, "qa-lines")
    records.unionByName(broken).write.text(path)
    options = QaOptions(inputs.QA_MIN_WORDS, inputs.QA_MAX_WORDS, num_shards_train=4, num_shards_test=2, dataset_format="json")
    return _as_rows(spark, build_qa_dataset(spark, path, new_path(spark, "set"), options))


# Tables of their own: one per early day and one for the rest; some have another number type, or a column less.
TABLES = "^2024_01_0[1-9]$"


@query(
    f"""SELECT strftime(ts, '%Y_%m_%d') AS month, event_id::BIGINT AS event_id, user_id::VARCHAR AS user_id,
  CASE WHEN day(ts) % 3 <> 1 THEN event_type END AS event_type FROM events WHERE regexp_matches(strftime(ts, '%Y_%m_%d'), '{TABLES}')"""
)
def tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy_MM_dd").alias("day"))
    root = new_path(spark, "daily")
    for k in range(1, 11):
        day = events.where(F.col("day") == f"2024_01_{k:02d}").drop("day")
        if k % 3 == 1:
            day = day.select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("string").alias("user_id"))
        day.coalesce(1).write.parquet(f"{root}/2024_01_{k:02d}")
    events.where("day > '2024_01_10'").write.parquet(f"{root}/2024_01_09_and_later")
    return read_tables(spark, root, TABLES).select("month", "event_id", "user_id", "event_type")
