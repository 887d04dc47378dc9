"""Long-format annotations: last duplicate wins, completeness, repair, consistency, status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The indicators in their order, and the codes that each allows.
INDICATORS = [
    "gender_equality_position", "women_leadership_position", "women_multilateral_leadership_position", "sg_selection_position",
    "sg_selection_position_gender", "un_reform_position", "current_multilateralism_position", "future_multilateralism_position",
]
REFORM_NAME, FUTURE_NAME = "un_reform_position", "future_multilateralism_position"
CLUSTERS = dict(zip(INDICATORS, ["Gender and women's leadership"] * 3 + ["SG election"] * 2 + ["UN reform"] + ["Multilateralism"] * 2))
STANDARD_LABELS = {0: "No Mention", 1: "Positive / Supportive", 2: "Mixed / Ambiguous", 3: "Negative / Pushback"}
FUTURE_LABELS = {0: "No Mention", 5: "Preservation / Strengthening", 2: "Mixed / Ambiguous", 6: "Transformation"}
STANDARD, FUTURE = list(STANDARD_LABELS), list(FUTURE_LABELS)
TOPICS = [
    "Climate change", "AI / digital transformation", "Peace and security", "Development / SDGs", "Inequality", "Financing / debt", "Human rights", "Migration",
    "Global health", "Food security", "Technology / digital divide", "Other",
]
#: A code of the first other than 0 expects the second to be other than 0.
NESTED = [("sg_selection_position_gender", "sg_selection_position"), ("sg_selection_position_gender", "gender_equality_position"), ("women_multilateral_leadership_position", "women_leadership_position")]
ALIGNED = 6


def _labels(names: dict, key):
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)


def option(name, code):
    """The label of a code in its indicator's code book, empty for others."""
    return F.coalesce(F.when(name == FUTURE_NAME, _labels(FUTURE_LABELS, code)).otherwise(_labels(STANDARD_LABELS, code)), F.lit(""))


def cluster(name):
    return F.coalesce(_labels(CLUSTERS, name), F.lit(""))


def canonical_topic(raw):
    """The topic of the closed list that is meant, blind to case; null for others."""
    return _labels({t.lower(): t for t in TOPICS}, F.lower(F.trim(raw)))


def topic_slug(topic):
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.lower(F.trim(topic)), "[^a-z0-9]+", "_"), F.lit("_")), F.lit("")), F.lit("other"))


def emerging_rows(topics: DataFrame, complete: DataFrame) -> DataFrame:
    """id_speech, topic, extract_id and extract: the first of each known topic, of complete speeches only. topics has pos."""
    known = topics.withColumn("topic", canonical_topic(F.col("topic"))).where("topic IS NOT NULL").join(complete.select("id_speech").distinct(), "id_speech", "left_semi")
    first = known.groupBy("id_speech", "topic").agg(F.min_by("extract", "pos").alias("extract"))
    return first.select("id_speech", "topic", F.concat_ws("_", "id_speech", topic_slug(F.col("topic"))).alias("extract_id"), "extract")


def analysis_row(identity: dict, answer, columns: list[str]):
    """A model's answer (JSON text) as a struct of the columns: identity fields as given, null and missing ones empty, lists and objects as JSON."""
    value = lambda c: F.coalesce(F.trim(F.get_json_object(answer, f"$['{c}']")), F.lit(""))
    return F.struct(*[(F.coalesce(identity[c].cast("string"), F.lit("")) if c in identity else value(c)).alias(c) for c in columns])


def allowed(name, code):
    return F.when(name == FUTURE_NAME, code.isin(FUTURE)).otherwise(code.isin(STANDARD))


def dimension(spark) -> DataFrame:
    return spark.createDataFrame([(i, n) for i, n in enumerate(INDICATORS)], "position int, indicator_name string")


def last_codes(payload: DataFrame) -> DataFrame:
    """(id_speech, indicator_name, code, extract): the last duplicate of each known indicator. payload has pos."""
    known = payload.where(F.col("indicator_name").isin(INDICATORS))
    return known.groupBy("id_speech", "indicator_name").agg(F.max_by("code", "pos").alias("code"), F.max_by("extract", "pos").alias("extract"))


def incomplete(speeches: DataFrame, codes: DataFrame) -> DataFrame:
    """id_speech and the names that are missing or invalid, in the fixed order."""
    grid = speeches.select("id_speech").crossJoin(F.broadcast(dimension(speeches.sparkSession)))  # eight rows
    g = grid.join(codes, ["id_speech", "indicator_name"], "left")
    bad = F.col("code").isNull() | ~allowed(F.col("indicator_name"), F.col("code"))
    listed = g.where(bad).groupBy("id_speech").agg(F.array_sort(F.collect_list(F.struct("position", "indicator_name"))).alias("_m"))
    return listed.select("id_speech", F.array_join(F.transform("_m", lambda x: x["indicator_name"]), ",").alias("missing"))


def complete_rows(speeches: DataFrame, codes: DataFrame) -> DataFrame:
    """Eight rows for each complete speech; a code of 0 blanks the extract."""
    good = codes.join(speeches.select("id_speech"), "id_speech", "left_semi").where(allowed(F.col("indicator_name"), F.col("code")))
    full = good.groupBy("id_speech").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(INDICATORS)).select("id_speech")
    return good.join(full, "id_speech", "left_semi").withColumn("extract", F.when(F.col("code") == 0, "").otherwise(F.coalesce("extract", F.lit(""))))


def aligned(rows: DataFrame, note: str = "aligned with un_reform") -> DataFrame:
    """Where un_reform is 1, future becomes 6, with a note."""
    per = Window.partitionBy("id_speech")
    reform = F.max(F.when((F.col("indicator_name") == REFORM_NAME) & (F.col("code") == 1), 1).otherwise(0)).over(per) == 1
    fix = reform & (F.col("indicator_name") == FUTURE_NAME) & (F.col("code") != ALIGNED)
    noted = F.when(fix, note).otherwise("")
    return rows.withColumn("_fix", fix).withColumn("note", noted).withColumn("code", F.when(F.col("_fix"), ALIGNED).otherwise(F.col("code"))).drop("_fix")


def warnings(rows: DataFrame) -> DataFrame:
    """id_speech and message of every broken consistency rule; a missing code counts as 0."""
    wide = rows.groupBy("id_speech").pivot("indicator_name", INDICATORS).agg(F.max("code"))
    at = lambda n: F.coalesce(F.col(n), F.lit(0))
    rules = [F.when((at(a) != 0) & (at(b) == 0), F.lit(f"{a} without {b}")) for a, b in NESTED]
    rules.append(F.when((at(REFORM_NAME) == 1) & F.col(FUTURE_NAME).isNotNull() & (F.col(FUTURE_NAME) != ALIGNED), F.lit("un_reform with another future")))
    return wide.select("id_speech", F.explode(F.array_compact(F.array(*rules))).alias("message"))


def status(indicators: DataFrame, emerging: DataFrame) -> DataFrame:
    """id_speech, numbers of indicator and emerging rows, and the first model that is not empty."""
    a = indicators.groupBy("id_speech").agg(F.count(F.lit(1)).alias("indicators"), F.min(F.when(F.col("model") != "", F.struct("pos", "model"))).alias("_m"))
    b = emerging.groupBy("id_speech").agg(F.count(F.lit(1)).alias("emerging"))
    both = a.join(b, "id_speech", "full")
    return both.select("id_speech", F.coalesce("indicators", F.lit(0)).alias("indicators"), F.coalesce("emerging", F.lit(0)).alias("emerging"), F.coalesce("_m.model", F.lit("")).alias("model"))


def agreement(pairs: DataFrame) -> DataFrame:
    """Share of equal codes for each indicator; pairs has indicator_name, human and machine."""
    return pairs.groupBy("indicator_name").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("human") == F.col("machine")).cast("double")).alias("agreement"))


def confusion(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("indicator_name", "human", "machine").agg(F.count(F.lit(1)).alias("n"))


def krippendorff_alpha(pairs: DataFrame) -> DataFrame:
    """indicator_name and nominal alpha of two coders (human, machine): 1 - observed over expected disagreement; null where all codes are equal.

    Only counts of (indicator, human, machine) meet, which the code book bounds.
    """
    cells = pairs.where(F.col("human").isNotNull() & F.col("machine").isNotNull()).groupBy("indicator_name", "human", "machine").agg(F.count(F.lit(1)).alias("n"))
    observed = cells.groupBy("indicator_name").agg(F.sum(F.when(F.col("human") != F.col("machine"), F.col("n")).otherwise(0)).alias("_apart"), F.sum("n").alias("_units"))
    values = cells.select("indicator_name", F.explode(F.array("human", "machine")).alias("v"), "n").groupBy("indicator_name", "v").agg(F.sum("n").alias("m"))
    same = values.groupBy("indicator_name").agg(F.sum(F.col("m") * (F.col("m") - 1)).alias("_same"))
    total = 2 * F.col("_units")
    expected = 1 - F.col("_same") / (total * (total - 1))
    return observed.join(same, "indicator_name").select("indicator_name", F.when(expected > 0, 1 - (F.col("_apart") / F.col("_units")) / expected).alias("alpha"))
