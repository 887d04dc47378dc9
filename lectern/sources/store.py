"""The store of speeches and their quotes, snapshots of a day, roster documents and date indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fuzzy import fold_name
from ..operators.dims import leaked_names
from ..operators.publish import export_title
from ..operators.rows import keep_first

HIT = "timestamp string, keyword string, speaker string, speaker_title string, context string, video_seconds double, timestamp_reliable boolean, watch_url string, webtv_url string"
SPEECHES = f"name string, country string, title string, lines array<struct<start:double,end:double,text:string>>, quotes array<struct<{HIT.replace(' string', ':string').replace(' double', ':double').replace(' boolean', ':boolean').replace(', ', ',')}>>"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """day and the fields of every hit of day snapshots (DAY.json), each a list of hits or an object with them under `hits`; files that are neither give nothing."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("day"), F.trim("value").alias("value"))
    return parse_snapshots(files)


def parse_snapshots(files: DataFrame) -> DataFrame:
    """The same over rows of day and value."""
    kind = f"array<struct<{HIT.replace(' string', ':string').replace(' double', ':double').replace(' boolean', ':boolean').replace(', ', ',')}>>"
    listed = F.when(F.col("value").startswith("["), F.from_json("value", kind)).otherwise(F.from_json("value", f"hits {kind}")["hits"])
    return files.select("day", F.posexplode(listed).alias("position", "h")).select("day", "position", "h.*").where(F.coalesce("keyword", F.lit("")) != "")


def read_store(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """speeches, lines and quotes of a store: a row for each, with speaker and position. Speeches without a name are left out."""
    s = spark.read.schema(SPEECHES).json(path).where(F.trim(F.coalesce("name", F.lit(""))) != "").withColumnRenamed("name", "speaker")
    return {
        "speeches": s.select("speaker", "country", "title"),
        "lines": s.select("speaker", F.posexplode("lines").alias("position", "l")).select("speaker", "position", "l.*"),
        "quotes": s.select(F.col("speaker").alias("owner"), F.posexplode("quotes").alias("position", "q")).select("owner", "position", "q.*"),
    }


def write_store(tables: dict[str, DataFrame], path: str) -> None:
    """The tables as one JSON line for each speech, in place of what was there. A speech's lines and quotes are what one speech holds."""
    pack = lambda df, key, name: df.groupBy(F.col(key).alias("name")).agg(F.array_sort(F.collect_list(F.struct("position", F.struct(*[c for c in df.columns if c not in (key, "position")]).alias("row")))).alias("_a")).select("name", F.transform("_a", lambda x: x["row"]).alias(name))
    out = tables["speeches"].withColumnRenamed("speaker", "name").join(pack(tables["lines"], "speaker", "lines"), "name", "left").join(pack(tables["quotes"], "owner", "quotes"), "name", "left")
    out.write.mode("overwrite").json(path)


def agenda_of_roster(roster: DataFrame, position: str = "position") -> DataFrame:
    """position, name, country and title of a roster document as an agenda: leaked names give way to the country, of equal folded names the first counts."""
    low = F.lower(F.coalesce(F.trim("name"), F.lit("")))
    bad = leaked_names(roster.where("trim(name) <> '' AND trim(country) <> ''")).select(F.col("name").alias("_low"), F.lit(True).alias("_bad"))
    rows = roster.withColumn("_low", low).join(bad, "_low", "left")
    country = F.coalesce(F.trim("country"), F.lit(""))
    name = F.when(F.col("_bad"), F.lit("")).otherwise(F.coalesce(F.trim("name"), F.lit("")))
    named = rows.select(F.col(position).alias("position"), F.coalesce(F.nullif(name, F.lit("")), country).alias("name"), country.alias("country"), export_title(F.col("rank"), F.col("speaker_title")).alias("title")).where("name <> ''")
    return keep_first(named.withColumn("_key", fold_name("name")), ["_key"], [F.col("position")]).drop("_key")


def date_index(files: DataFrame, value: str = "value") -> DataFrame:
    """slug and day of a date index (one JSON object of slug to date); empty dates are left out, dates are cut to ten characters."""
    pairs = F.explode(F.from_json(value, "map<string,string>")).alias("slug", "day")
    return files.select(pairs).where(F.coalesce("day", F.lit("")) != "").withColumn("day", F.left("day", F.lit(10)))


def read_date_index(spark: SparkSession, path: str) -> DataFrame:
    return date_index(spark.read.text(path, wholetext=True))


def speech_files(paths: DataFrame, session: int, day: str | None = None, path: str = "path") -> DataFrame:
    """path, day and stem of the .txt files below SESSION/DAY/, of one day if that is given."""
    p = F.regexp_extract(path, rf"(?:^|/){session}/([^/]+)/([^/]+)\.txt$", 1)
    out = paths.select(path, p.alias("day"), F.regexp_extract(path, rf"(?:^|/){session}/([^/]+)/([^/]+)\.txt$", 2).alias("stem")).where("day <> ''")
    return out if day is None else out.where(F.col("day") == day)
