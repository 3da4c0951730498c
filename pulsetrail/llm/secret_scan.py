"""Secret scan over an incremental ledger of text blobs.

Every version of a text is addressed by the SHA-256 of its content. A run looks up which
(blob, rule version) pairs the ledger has, scans only the others, appends their spans to
the ledger, and joins all spans back to every row that has the blob. A second run over
the same texts scans nothing; raising ``RULES_VERSION`` scans everything again.

All work is SQL functions. The places of the matches come from splitting a text at the
pattern: the pieces between matches and the matches alternate, so running sums of their
lengths are the starts and ends. The sums are windows over the matches of one blob and
rule, in linear time however many matches a text has. Only texts that a pattern occurs
in are split.

Defined cases: a null text is the empty text; rows may repeat and ids may be null, every
row gets the findings of its blob; the empty text has no spans and the digest of the
empty string; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are not read. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize, scratch_path

RULES_VERSION = 1

# kind, pattern, value group, least length of the value. Matches are leftmost and do not
# overlap within a kind. For a pattern that is one run of a class the least length stands
# in the pattern itself; an assignment is matched first and dropped if its value is short.
BASE_RULES = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
EXTRA_RULES = (
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
)
RULES = BASE_RULES + EXTRA_RULES

_SPAN = "struct<start:bigint,kind:int,stop:bigint>"
_LEDGER = f"blob string, rules int, spans array<{_SPAN}>"


def _parts(text: Column, kind: int, rule: tuple) -> Column:
    """Lengths of the piece before, the match and its value, for every match of a rule."""
    _, pattern, group, _ = rule
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("piece"),
        matches.alias("found"),
        values.alias("value"),
    )
    lengths = F.transform(
        zipped,
        lambda m: F.struct(
            F.length(m["piece"]).cast("long").alias("before"),
            F.length(m["found"]).cast("long").alias("size"),
            F.length(m["value"]).cast("long").alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), F.struct(F.lit(kind).alias("kind"), lengths.alias("parts")))


def scan(blobs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``blob`` and sorted ``spans`` (start, kind number, stop) of every given blob."""
    found = F.array_compact(F.array(*[_parts(F.col("text"), k, r) for k, r in enumerate(rules)]))
    least = F.element_at(
        F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (k, r[3])]), F.col("kind")
    )
    each = (
        blobs.select("blob", F.explode_outer(found).alias("hit"))
        .select("blob", F.col("hit.kind").alias("kind"), F.posexplode_outer("hit.parts"))
        .select("blob", "kind", "pos", "col.before", "col.size", "col.value")
    )
    place = Window.partitionBy("blob", "kind").orderBy("pos")
    stop = F.sum(F.col("before") + F.col("size")).over(place)
    spans = each.withColumn("stop", stop).withColumn("start", F.col("stop") - F.col("size"))
    kept = F.when(F.col("value") >= least, F.struct("start", "kind", "stop"))
    return spans.groupBy("blob").agg(F.sort_array(F.collect_list(kept)).alias("spans"))


def scan_ledger(versions: DataFrame, ledger: str, rules_version: int = RULES_VERSION) -> DataFrame:
    """Scan the blobs of ``versions`` (blob, text) that the ledger lacks; return the ledger.

    ``ledger`` is a folder that grows by one append per run, and is created by the first.
    """
    spark = versions.sparkSession
    stored = read_ledger(spark, ledger)
    known = stored.where(F.col("rules") == rules_version).select("blob")
    unseen = versions.join(known, "blob", "left_anti").groupBy("blob").agg(F.first("text").alias("text"))
    scan(unseen).select("blob", F.lit(rules_version).alias("rules"), "spans").write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger).where(F.col("rules") == rules_version)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(ledger)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(rule[0]) for rule in RULES])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(spans, one), ",")


def find_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_<kind> of the base kinds, base_sha256, spans.

    Without a ``ledger`` folder the run starts an empty one in the shared folder.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    versions = docs.select("doc_id", F.sha2(text, 256).alias("blob"), text.alias("text"))
    links = materialize(versions.select("doc_id", "blob"))
    ledger = ledger or scratch_path(spark, "ledger")
    stored = scan_ledger(versions.select("blob", "text"), ledger)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    # Runs side by side can both scan a blob; what they find is the same.
    per_blob = stored.groupBy("blob").agg(F.first("spans").alias("spans")).select(
        "blob",
        *[count(k).alias(f"n_{rule[0]}") for k, rule in enumerate(BASE_RULES)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
    return links.join(per_blob, "blob", "left").drop("blob")


