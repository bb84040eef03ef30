"""Secret scan that links the parts of credentials.

Base kinds are reported wherever they match. Weak kinds (identifiers, short or unnamed secrets, endpoints) are
reported only when what completes them stands near: parts are ordered inside their scope, a paragraph, and two
ordered windows find for every weak part the nearest parts of the other classes, the ones an interval join would
give. Everything is built-in expressions; only parts are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import materialize, plain_names, small_enough, text_of
from flowlens.llm.text_spans import SPAN, matches, places

# Fixed patterns of the base kinds, and the least lengths.
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]\x20*[\x22']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the first AKIA of a run takes all of it, so this equals 18 or more characters
HEX = r"[0-9a-f]{16,}"  # likewise

# Patterns of the weak kinds.
IDENTIFIER = (r"(?i)(?:access_?key_?id|client_?id|account|user_?name|user|login)[\x22']?\x20*[:=]\x20*[\x22']?"
              r"[A-Za-z0-9@._+-]{3,}")
UNNAMED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = (r"(?i)(?:https?|sftp|ftp|ssh|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\x22'<>]+"
            r"|(?:host|endpoint|server)[\x22']?\x20*[:=]\x20*[\x22']?[A-Za-z0-9.-]{4,}")
SCOPE = r"\n[\x20\t]*\n"
SHORT_SECRET = 6
#: Most code points between the end of one part and the start of the next that belongs to it.
REACH = 200

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
PARTS = "array<struct<start:int,kind:int,end:int>>"


def _kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _sized(text: Column, pattern: str, group: int, test) -> Column:
    """Places of the matches whose ``group`` passes ``test``."""
    zipped = F.arrays_zip(places(text, pattern).alias("place"), matches(text, pattern, group).alias("value"))
    kept = F.transform(F.filter(zipped, lambda x: test(x["value"])), lambda x: x["place"])
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPAN))


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def find_parts(docs: DataFrame) -> DataFrame:
    """``docs`` with _base (spans of base kinds), _weak (spans of weak kinds and scope breaks) and _key.

    Weak parts are sought only where there is an identifier, as nothing can be linked without one. Texts with
    parts to link share a key if they are equal; every other row has a key of its own kind.
    """
    text = text_of()
    base = docs.withColumn("_base", F.concat(
        _kind(_sized(text, ASSIGN, 2, lambda v: F.char_length(v) >= ASSIGN_LENGTH), 0),
        _kind(places(text, ACCESS), 1), _kind(places(text, HEX), 2)))
    named = text.rlike(IDENTIFIER) | F.exists("_base", lambda s: s["kind"] == 1)
    weak = F.concat(
        _kind(places(text, IDENTIFIER), 3),
        _kind(F.concat(_sized(text, ASSIGN, 2, lambda v: F.char_length(v).between(SHORT_SECRET, ASSIGN_LENGTH - 1)),
                       _sized(text, UNNAMED, 0, _mixed)), 4),
        _kind(places(text, ENDPOINT), 5), _kind(places(text, SCOPE), 6))
    found = base.withColumn("_weak", F.when(named, weak).otherwise(F.array().cast(PARTS)))
    linkable = F.exists("_weak", lambda s: s["kind"] < 6) & (
        F.exists("_weak", lambda s: s["kind"] == 4) | F.exists("_base", lambda s: s["kind"] != 1))
    return found.withColumn("_key", F.when(linkable, F.sha2(text.cast("binary"), 256)))


def link(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """(_key, _linked): weak spans of each distinct text whose complementary parts stand in reach, in one scope.

    An identifier needs a secret and a secret an identifier, and one of the two must be of a base kind or an
    endpoint must be near as well. An endpoint needs both.
    """
    rows = (parts.where("_key IS NOT NULL").select("_key", F.concat("_base", "_weak").alias("parts"))
            .dropDuplicates(["_key"]).select("_key", F.explode("parts").alias("p")).select("_key", "p.*"))
    ordered = Window.partitionBy("_key").orderBy("start", F.desc("kind"), "end")
    rows = rows.withColumn("scope", F.sum((F.col("kind") == 6).cast("int")).over(ordered)).where("kind < 6")
    scope = Window.partitionBy("_key", "scope").orderBy("start", "kind", "end")
    before, after = scope.rowsBetween(Window.unboundedPreceding, 0), scope.rowsBetween(0, Window.unboundedFollowing)

    def near(kinds: tuple[int, ...]) -> Column:
        of = lambda place: F.when(F.col("kind").isin(*kinds), F.col(place))
        gap = F.least(F.col("start") - F.max(of("end")).over(before), F.min(of("start")).over(after) - F.col("end"))
        return F.coalesce(gap <= reach, F.lit(False))

    rows = rows.withColumns({"strong_id": near((1,)), "any_id": near((1, 3)), "strong_secret": near((0, 2)),
                             "any_secret": near((0, 2, 4)), "end_point": near((5,))})
    complete = (
        F.when(F.col("kind") == 3, F.col("any_secret") & (F.col("strong_secret") | F.col("end_point")))
        .when(F.col("kind") == 4, F.col("any_id") & (F.col("strong_id") | F.col("end_point")))
        .when(F.col("kind") == 5, F.col("any_id") & F.col("any_secret")))
    return (rows.where(complete).groupBy("_key")
            .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("_linked")))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``docs`` with ``secret_spans``: all reported spans by start, then kind.

    A NULL or empty text has none; repeated rows each keep their row; extra columns may have any name, but one
    named secret_spans is replaced. Spans of one base kind never overlap, others may.
    """
    docs = docs.drop("secret_spans")
    plain = plain_names(docs, "text")
    linked = small_enough(materialize(link(find_parts(docs.select("text")), reach), "linked"))
    # Rows without parts to link have no partner; a key of their own spreads them evenly if the join shuffles.
    spread = find_parts(plain).withColumn("_key", F.coalesce("_key", F.xxhash64(*plain.columns).cast("string")))
    return (spread.join(linked, "_key", "left")
            .withColumn("_spans", F.array_sort(F.concat("_base", F.coalesce("_linked", F.array().cast(PARTS)))))
            .select(*plain.columns, "_spans").toDF(*docs.columns, "secret_spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans, of every row."""
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)
    n = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select(F.col("doc_id").cast("long"), "text")).select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span of the text replaced; overlapping spans become one mark.

    Rows without secrets keep their text as it is, NULL included. Extra columns may have any name.
    """
    plain = plain_names(docs, "text")
    found = scan(plain)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        return (F.when(s["end"] <= acc["at"], acc)
                .when(s["start"] < acc["at"], F.struct(s["end"].alias("at"), acc["out"].alias("out")))
                .otherwise(F.struct(s["end"].alias("at"), F.concat(
                    acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"))))

    cleaned = F.aggregate("secret_spans", zero, step)
    rest = F.expr("substring(text, _done.at + 1)")
    return (found.withColumn("_done", F.when(F.size("secret_spans") > 0, cleaned))
            .withColumn("text", F.when(F.col("_done").isNotNull(), F.concat("_done.out", rest)).otherwise(F.col("text")))
            .select(*plain.columns).toDF(*docs.columns))
