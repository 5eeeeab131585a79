"""Readers and sinks: reports in JSON, OCR responses, dictionaries, indexes in HTML, graph packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REPORT = "struct<report_id:string,observations:array<struct<raw_name:string,standard_name:string,abbreviation:string,value:string,unit:string,lower:string,upper:string,flag:string>>>"
OCR = "struct<pages:array<struct<texts:array<string>,scores:array<double>,boxes:array<array<double>>>>>"


def read_reports(raw: DataFrame, column: str = "raw_response") -> DataFrame:
    """``report_id, no, key, ..., problem``: one row per observation of a JSON report.

    ``key`` is the standard name, else the abbreviation, else the raw name. ``problem`` names what is wrong: a text that
    is no such JSON (``not_a_report``), an observation without any name (``no_key``), or a key that repeats in its
    report (``repeated_key``). Null texts are ``not_a_report``.
    """
    r = raw.select(F.col(column).alias("_raw"), F.from_json(column, REPORT).alias("r"))
    bad = r.filter("r is null or r.observations is null").select(F.col("r.report_id").alias("report_id"), F.lit(None).cast("int").alias("no"), F.lit(None).cast("string").alias("key"), F.lit("not_a_report").alias("problem"))
    o = r.filter("r.observations is not null").select("r.report_id", F.posexplode("r.observations").alias("no", "o"))
    key = F.coalesce(F.nullif("o.standard_name", F.lit("")), F.nullif("o.abbreviation", F.lit("")), F.nullif("o.raw_name", F.lit("")))
    o = o.select("report_id", "no", key.alias("key"), "o.*")
    n = o.groupBy("report_id", "key").agg(F.count(F.lit(1)).alias("_n"))
    o = o.join(n.withColumnsRenamed({"report_id": "_r", "key": "_k"}), F.col("report_id").eqNullSafe(F.col("_r")) & F.col("key").eqNullSafe(F.col("_k")), "left")
    problem = F.when(F.col("key").isNull(), "no_key").when(F.col("_n") > 1, "repeated_key")
    return o.withColumn("problem", problem).drop("_n", "_r", "_k").unionByName(bad, allowMissingColumns=True)


def read_ocr(raw: DataFrame, column: str = "raw_response") -> DataFrame:
    """``doc_id, page, line, text, score, top, left, height``: lines of OCR responses whose arrays align.

    ``raw`` has ``doc_id`` and the response. Pages with arrays of different length give one row with null text.
    """
    p = raw.select("doc_id", F.posexplode(F.from_json(column, OCR)["pages"]).alias("page", "p"))
    same = (F.size("p.texts") == F.size("p.scores")) & (F.size("p.texts") == F.size("p.boxes"))
    zipped = F.when(same, F.arrays_zip(F.col("p.texts").alias("texts"), F.col("p.scores").alias("scores"), F.col("p.boxes").alias("boxes")))
    z = p.select("doc_id", "page", F.posexplode_outer(zipped).alias("line", "z"))
    return z.select("doc_id", "page", "line", F.col("z.texts").alias("text"), F.col("z.scores").alias("score"), F.col("z.boxes")[1].alias("top"), F.col("z.boxes")[0].alias("left"), (F.col("z.boxes")[3] - F.col("z.boxes")[1]).alias("height"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """A reviewed dictionary in TSV with a header; aliases are parted by ``|``, only approved entries are kept."""
    d = spark.read.csv(path, sep="\t", header=True)
    aliases = F.when(F.col("aliases").isNull() | (F.col("aliases") == ""), F.array().cast("array<string>")).otherwise(F.split("aliases", r"\|"))
    return d.filter(F.upper("review_status") == "APPROVED").withColumn("aliases", aliases)


def html_rows(pages: DataFrame, column: str) -> DataFrame:
    """``page_id, no, cells``: rows of HTML tables as arrays of plain cell texts."""
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), "&lt;", "<"), "&gt;", ">"), "&amp;", "&"))
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all(column, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("no", "row"))
    return rows.select("page_id", "no", F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), plain).alias("cells"))


def index_entries(pages: DataFrame, column: str) -> DataFrame:
    """``abbreviation, full_name, local_name`` from two-cell index rows ``abbreviation full name | local name``."""
    r = html_rows(pages, column).filter(F.size("cells") == 2)
    return r.select("page_id", F.regexp_extract(F.col("cells")[0], r"^([A-Z0-9%#-]+)\s+(.+)$", 1).alias("abbreviation"), F.regexp_extract(F.col("cells")[0], r"^([A-Z0-9%#-]+)\s+(.+)$", 2).alias("full_name"), F.col("cells")[1].alias("local_name")).filter("abbreviation <> ''")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Append-only review decisions in JSON lines; broken lines are skipped, the last decision of an item counts."""
    d = spark.read.schema("item_id string, decision string, decided_at timestamp").json(path, mode="DROPMALFORMED").filter("item_id is not null")
    return d.groupBy("item_id").agg(F.max_by("decision", F.struct("decided_at", "decision")).alias("decision"))


def write_package(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write a package of tables as parquet (it must not exist yet) and return its manifest ``name, n_rows, digest``.

    The digest is the sum of the row hashes, so it does not depend on the order of the rows.
    """
    spark = next(iter(tables.values())).sparkSession
    manifest = None
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        back = spark.read.parquet(f"{path}/{name}")
        h: Column = F.xxhash64(*back.columns).cast("decimal(38,0)")
        row = back.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string").alias("digest")).select(F.lit(name).alias("name"), "n_rows", "digest")
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.write.mode("errorifexists").parquet(f"{path}/_manifest")
    return spark.read.parquet(f"{path}/_manifest")


def changed_tables(spark: SparkSession, path: str) -> DataFrame:
    """``name`` of the package's tables that no longer match its manifest."""
    known = spark.read.parquet(f"{path}/_manifest").collect()  # a row per table of the package
    bad = []
    for r in known:
        back = spark.read.parquet(f"{path}/{r.name}")
        now = back.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*back.columns).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("d")).first()
        if (now.n, now.d) != (r.n_rows, r.digest):
            bad.append((r.name,))
    return spark.createDataFrame(bad, "name string")
