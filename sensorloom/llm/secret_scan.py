"""Secrets in every version of every path, by an incremental ledger of blobs.

A version is a row with a text.  Its content has an address, the SHA-256 of the
text; versions of equal content, under whatever path, are one blob.  The ledger is
a table with a row for each blob and scan: the rules it was scanned by, each as
``name@version``, and what they found.  A scan takes the pairs of blob and rule
version that the ledger doesn't have yet, applies just these rules to just these
blobs, and appends the outcome.  Findings then go back to all paths that hold the
blob.  A second scan of the same versions reads the ledger only; a new rule, or a
new version of one, is applied to old blobs as well, alone.

Only column functions are used.  Digests, not texts, are shuffled to find out what
is unseen; of an unseen blob one copy per task is.  The ledger is appended to by one
write, and a repeated entry (of a scan that was run twice) changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.spans import joined, with_matches
from sensorloom.llm.tables import saved

LEDGER = (
    "blob string, rules array<string>, "
    "findings array<struct<start:int,kind_no:int,end:int,kind:string,rule:string>>"
)
#: Up to so many unseen blobs (of 64 bytes) are broadcast to pick their texts out.
FEW = 500_000


def _any(hit: Column) -> Column:
    return hit.isNotNull()


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts if ``valid`` says so.  Change ``version`` with either."""

    name: str
    pattern: str
    version: int = 1
    valid: Callable[[Column], Column] = _any

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


def _either_case(words: tuple[str, ...]) -> str:
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in words)


_KEYWORDS = _either_case(("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = rf"""(?:{_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def long_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, f"^{ASSIGN}", 1)) >= 12


#: The kinds of the contract, in its order.  The runs of access and hex need no
#: dropping: a shorter one has no longer match inside.
BASE = (
    Rule("assign", ASSIGN, valid=long_value),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
#: Further kinds.  No match of these can begin inside another's tail and run past it,
#: so that a search is linear in the text.
MORE = (
    Rule("private_key", "-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----"),
    Rule("url_password", r"://[^/:@\x09-\x0D\x20]+:[^/:@\x09-\x0D\x20]+@"),
    Rule("host_token", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE + MORE


def _content(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _address(text: Column) -> Column:
    return F.sha2(_content(text).cast("binary"), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger of this folder, which is made if it isn't there."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger)


def unseen(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rules): the blobs of these versions that some rules have not been applied to."""
    blobs = versions.select(_address(F.col("text")).alias("blob")).distinct()
    done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    missing = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", missing.alias("rules")).filter("size(rules) > 0")


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, few: int = FEW) -> None:
    """Bring the ledger up to date with the texts of these versions and with the rules."""
    spark = versions.sparkSession
    todo = saved(unseen(versions, read_ledger(spark, ledger), rules), "unseen_blobs")
    texts = versions.select(_address(F.col("text")).alias("blob"), _content(F.col("text")).alias("text"))
    if todo.count() <= few:
        texts = texts.join(F.broadcast(todo.select("blob")), "blob", "left_semi")
    blobs = texts.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
    scanned(blobs, rules).write.mode("append").parquet(ledger)


def scanned(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of (blob, text, rules): each rule that is asked for, applied to the text."""
    text = F.col("text")
    found = with_matches(
        blobs,
        text,
        {
            f"_found_{i}": (rule.pattern, F.array_contains("rules", rule.key))
            for i, rule in enumerate(rules)
        },
    )
    kind = "array<struct<start:int,kind_no:int,end:int,kind:string,rule:string>>"

    def findings(i: int, rule: Rule) -> Column:
        valid = F.filter(f"_found_{i}", lambda m: rule.valid(m["hit"]))
        as_finding = F.transform(
            valid,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(i).alias("kind_no"), m["end"].alias("end"),
                F.lit(rule.name).alias("kind"), F.lit(rule.key).alias("rule"),
            ),
        )
        return F.coalesce(as_finding, F.array()).cast(kind)

    every = F.array_sort(F.concat(*[findings(i, rule) for i, rule in enumerate(rules)]))
    return found.select("blob", "rules", every.alias("findings"))


def findings(
    versions: DataFrame, ledger: str, paths: tuple[str, ...], rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The ``paths`` columns of each version, its ``blob``, and ``findings`` by start, then kind.

    What the ledger has of other rules, or of other versions of them, is left out.
    """
    order = {rule.key: i for i, rule in enumerate(rules)}
    numbers = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    own = versions.select(
        F.struct(*[F.col(f"`{name}`") for name in paths]).alias("path"), _address(F.col("text")).alias("blob")
    )
    known = (
        read_ledger(versions.sparkSession, ledger)
        .select("blob", F.inline("findings"))
        .filter(F.col("rule").isin(*order))
        .withColumn("kind_no", numbers[F.col("rule")])
    )
    entry = F.struct("start", "kind_no", "end", "kind", "rule")
    by_blob = known.groupBy("blob").agg(F.array_sort(F.collect_set(entry)).alias("findings"))
    # Written, so that both sides of the join come from an exchange and a hot blob's paths can be split.
    joined_back = own.join(saved(by_blob, "findings"), "blob", "left")
    return joined_back.select(
        *[F.col(f"path.`{name}`").alias(name) for name in paths],
        "blob",
        F.coalesce("findings", F.array().cast(by_blob.schema["findings"].dataType)).alias("findings"),
    )


def report(documents: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, a digest of the contract's findings, and all findings of each row of (doc_id, text).

    Scans what the ledger doesn't know yet.  Rows are versions of the path doc_id:
    repeated ones have equal results, a null doc_id stays null, a null or empty text
    has no findings, an empty table gives no rows.  Other columns are not read.
    """
    scan(documents, ledger, rules)
    found = findings(documents.select("doc_id", "text"), ledger, ("doc_id",), rules)
    base = {rule.key for rule in BASE}
    of_base = F.filter("findings", lambda f: f["rule"].isin(*base))

    def count(rule: Rule) -> Column:
        return F.size(F.filter("findings", lambda f: f["rule"] == rule.key)).cast("long")

    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[count(rule).alias(f"n_{rule.name}") for rule in BASE],
        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
        "blob",
    )


def report_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same for DuckDB, row by row."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    parts = []
    for i, rule in enumerate(rules):
        pattern = quoted(rule.pattern)
        keep = f"length(regexp_extract(hits[i], {pattern}, 1)) >= 12" if rule.name == "assign" else "true"
        parts.append(f"""
          SELECT row, {i} AS kind_no, {quoted(rule.name)} AS kind, s, s + length(hits[i]) AS e FROM (
            SELECT row, hits, i, list_sum([length(g) FOR g IN gaps[:i]])
                     + coalesce(list_sum([length(h) FOR h IN hits[:i - 1]]), 0) AS s
            FROM (SELECT row, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
              SELECT row, regexp_extract_all(t, {pattern}) AS hits, string_split_regex(t, {pattern}) AS gaps
              FROM texts WHERE regexp_matches(t, {pattern})))
          ) WHERE {keep}""")
    base = ", ".join(
        f"count(*) FILTER (kind_no = {i}) AS n_{rule.name}" for i, rule in enumerate(rules[: len(BASE)])
    )
    line = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_no)"
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    lines AS (
      SELECT row, {base}, {line} FILTER (kind_no < {len(BASE)}) AS base, {line} AS spans
      FROM found GROUP BY row)
    SELECT doc_id, {", ".join(f"coalesce(n_{rule.name}, 0) AS n_{rule.name}" for rule in BASE)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob
    FROM texts LEFT JOIN lines USING (row)"""
