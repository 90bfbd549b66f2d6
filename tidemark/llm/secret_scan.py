"""Secret scan with corpus-wide ownership frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import query, table
from tidemark.staging import Staging

#: Kind, pattern, shortest value, group of the value.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    ("access", r"AKIA[A-Z0-9]{14,}", 18, 0),
    ("hex", r"[0-9a-f]{16,}", 16, 0),
)
#: Own kind: a long run of letters and digits that names no field; counted only if it looks made up and has few owners.
BARE = ("bare", r"[A-Za-z0-9_-]{24,}", 24, 0)
KINDS = ("assign", "access", "hex", "bare")
#: A text without this cannot match, so its pattern is not tried.
NEEDED = {"assign": r"contains(body, ':') or contains(body, '=')", "access": "contains(body, 'AKIA')", "hex": "true", "bare": "true"}
#: A value in more sources than this is a widely copied example.
LIVE_OWNERS = 1
BASE_KINDS = ("assign", "access", "hex")
MASK = "[secret]"
NO_SPANS = "cast(array() as array<struct<start:bigint,no:bigint,kind:string,end:bigint,value:string,owners:bigint,repositories:bigint,live:boolean>>)"


def _matches(kind: str, pattern: str, group: int) -> Column:
    """Matches of a pattern in ``body``: kind, index, characters skipped since the last match, length, value."""
    pieces = F.transform(F.split("body", pattern, -1), F.length)
    whole = F.regexp_extract_all("body", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("body", F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.filter(F.arrays_zip(pieces.alias("skipped"), whole.alias("whole"), value.alias("value")), lambda m: m["whole"].isNotNull())
    found = F.transform(
        zipped,
        lambda m, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), m["skipped"].alias("skipped"), F.length(m["whole"]).alias("length"), m["value"].alias("value")),
    )
    return F.when(F.expr(NEEDED[kind]), found).otherwise(F.array().cast("array<struct<kind:string,at:int,skipped:int,length:int,value:string>>"))


def matches(text: Column, docs: DataFrame) -> DataFrame:
    """``docs`` with ``found``, the raw matches of all kinds; null texts count as empty."""
    bodied = docs.withColumn("body", F.coalesce(text, F.lit("")))
    return bodied.withColumn("found", F.concat(*[_matches(kind, pattern, group) for kind, pattern, _, group in (*BASE, BARE)])).drop("body")


def judge(staging: Staging, found: DataFrame, census: DataFrame | None = None) -> DataFrame:
    """``row`` and ``spans`` of texts that have any, from rows (row, repository, owner, found).

    Spark gives the pieces between the matches, but no places: a running sum of lengths per text and kind gives
    those. Values are hashed, and each hash is counted by distinct repositories and owners: first once per hash,
    owner and repository, then per hash and owner, then per hash, so a value in a third of all texts is spread over
    all tasks. A value of at most ``LIVE_OWNERS`` owners is live-looking, any other a copied example. Owners are those of
    these texts and of the ``census``, more rows (repository, owner, found) of texts that are not judged. Only matches
    are shuffled, never texts. Spans are sorted by start, then kind: kind, start, end, value, owners,
    repositories, live.
    """
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    shortest = F.create_map(*[F.lit(x) for kind, _, least, _ in (*BASE, BARE) for x in (kind, least)])
    mixed = " and ".join(f"length(regexp_replace(value, '[^{chars}]', '')) >= {least}" for chars, least in (("0-9", 6), ("A-Z", 4), ("a-z", 4)))
    counted = (F.length("value") >= shortest[F.col("kind")]) & ((F.col("kind") != BARE[0]) | F.expr(mixed))
    placed = found.select("row", "repository", "owner", F.explode("found").alias("m")).select("row", "repository", "owner", "m.*")
    placed = placed.withColumn("end", F.sum(F.col("skipped") + F.col("length")).over(so_far)).withColumn("start", F.col("end") - F.col("length")).where(counted)
    placed = placed.select("row", "repository", "owner", "kind", order.alias("no"), "start", "end", "value", F.sha2("value", 256).alias("key"))
    placed = staging.freeze(placed, "candidates")
    holders = placed.select("key", "owner", "repository")
    if census is not None:
        others = census.select("owner", "repository", F.explode("found").alias("m")).select("owner", "repository", "m.kind", "m.value").where(counted)
        holders = holders.unionByName(others.select(F.sha2("value", 256).alias("key"), "owner", "repository"))
    per_owner = holders.distinct().groupBy("key", "owner").agg(F.count("*").alias("repositories"))
    owners = per_owner.groupBy("key").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    judged = placed.drop("repository").join(owners.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
    span = F.struct("start", "no", "kind", "end", "value", "owners", "repositories", (F.col("owners") <= LIVE_OWNERS).alias("live"))
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] != BARE[0])
    alone = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    kept = F.filter("spans", lambda s: (s["kind"] != BARE[0]) | (s["live"] & alone(s)))
    return spans.withColumn("base", base).select("row", kept.alias("spans"))


def scan(staging: Staging, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row per text: id and ``spans`` as in :func:`judge`, null where there are none.

    Null and empty texts have no spans; a null owner is an owner of its own; repeated rows are scanned each and
    are one repository where their repository is the same; long texts are scanned whole; an empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(text_col).alias("_text"))
    rows = staging.freeze(matches(F.col("_text"), rows).drop("_text"), "matches")
    spans = judge(staging, rows.where(F.size("found") > 0)).withColumnRenamed("row", "_row")
    return rows.join(spans, F.col("row") == F.col("_row"), "left").select(F.col("id").alias(id_col), "spans")


def mask_live(
    staging: Staging, docs: DataFrame, text_col: str = "text", repository: str = "doc_id", owner: str = "source", census: DataFrame | None = None
) -> DataFrame:
    """``docs`` with every live-looking value in its text replaced; copied examples and all other columns stay.

    Rows without any match pass straight through; only the others are shuffled with their text. ``census`` is a table
    with the same columns whose texts count for owners and repositories, such as the corpus before its copies went:
    what many sources copied is an example, also where one copy is left. Null and empty texts have no match, repeated
    rows are masked each, and an empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(text_col).alias("_text"), F.struct("*").alias("doc")
    )
    rows = staging.freeze(matches(F.col("_text"), rows).drop("_text"), "matches")
    touched = rows.where(F.size("found") > 0)
    live = F.array_distinct(F.transform(F.filter("spans", lambda s: s["live"]), lambda s: s["value"]))
    longest_first = F.array_sort(live, lambda a, b: F.length(b) - F.length(a))
    if census is not None:
        census = census.select(F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(text_col).alias("_text"))
        census = matches(F.col("_text"), census).where(F.size("found") > 0)
    values = judge(staging, touched, census).select(F.col("row").alias("_row"), longest_first.alias("_values"))
    joined = touched.join(values, F.col("row") == F.col("_row"), "left")
    masked = F.aggregate("_values", F.col(f"doc.{text_col}"), lambda text, value: F.replace(text, value, F.lit(MASK)))
    text = F.when(F.size("_values") > 0, masked).otherwise(F.col(f"doc.{text_col}"))
    masked_rows = joined.select(*[(text if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
    return rows.where(F.size("found") == 0).select("doc.*").unionByName(masked_rows)


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(Staging(spark), table(spark, sf_dir, "documents")).withColumn("spans", F.coalesce("spans", F.expr(NO_SPANS)))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *map(count, BASE_KINDS),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_example"),
    )
