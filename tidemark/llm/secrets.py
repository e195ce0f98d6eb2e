"""Secret scan: known forms, and entropy of sliding windows, in DataFrame functions only.

Known forms are found by patterns. Beyond them, candidate strings (long runs of characters that
keys are made of) get the Shannon entropy of every window, for the class of characters of the
candidate: counts are updated by the character that enters and the one that leaves, and the sum
of c * log2(c) with them, so a window costs the same whatever its width. A candidate whose best
window reaches the threshold of its class is reported, unless a known form covers it or the
allow-list explains it.

Positions are code points, end exclusive. Defined results: null text is empty and has no span;
equal rows are scanned each; an empty table gives an empty result; columns other than id and text
are left out. Matches of known forms are never suppressed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The known forms, in the order of their names in a result.
FORMS = {
    "assign": (
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
}
ENTROPY = "entropy"
KINDS = (*FORMS, ENTROPY)


@dataclass(frozen=True)
class CharClass:
    """Candidates that match `pattern` in full; the window and the bits a character that it needs."""

    name: str
    pattern: str
    window: int
    bits: float


#: From narrow to wide; the first that matches is the class of a candidate.
CLASSES = (
    CharClass("hex", "^[0-9a-fA-F]+$", 24, 3.2),
    CharClass("alnum", "^[A-Za-z0-9]+$", 20, 3.9),
    CharClass("base64", "^[A-Za-z0-9+/_=-]+$", 24, 4.1),
)
#: Runs that are looked at; all classes are within these characters.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Candidates that are explained: no digit at all, one letter case and separators of words or paths, ids of
#: fixed form, and placeholders.
ALLOWED = (
    r"^[^0-9]+$",
    r"^[0-9_+/=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^([A-Za-z]+|[0-9]+)([/_=-]+([A-Za-z]+|[0-9]+))+$",
    r"(?i)example|placeholder|your_?key|abcdef0123|0123456789|xxxx",
)


def _spans(pattern: str, found: str, pieces: str) -> Column:
    """(start, end, value) of each match, from the matches and the pieces of text between them."""
    return F.aggregate(
        F.arrays_zip(F.col(found).alias("m"), F.slice(F.col(pieces), 1, F.size(found)).alias("g")),
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast("array<struct<s:bigint,e:bigint,v:string>>").alias("out"),
        ),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["g"]) + F.length(x["m"])).cast("long").alias("at"),
            F.concat(
                a["out"],
                F.array(
                    F.struct(
                        (a["at"] + F.length(x["g"])).cast("long").alias("s"),
                        (a["at"] + F.length(x["g"]) + F.length(x["m"])).cast("long").alias("e"),
                        x["m"].alias("v"),
                    )
                ),
            ),
        ),
        lambda a: a["out"],
    )


_NO_SPANS = "array<struct<s:bigint,e:bigint,v:string>>"


def _located(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """Column `name`: spans of all matches; the text is cut only where there is one."""
    df = df.withColumn("_m", F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0)))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.split(F.col("text"), pattern, -1)))
    spans = F.when(F.size("_m") > 0, _spans(pattern, "_m", "_g")).otherwise(F.array().cast(_NO_SPANS))
    return df.withColumn(name, spans).drop("_m", "_g")


def best_entropy(value: Column, window: int) -> Column:
    """The largest entropy, in bits a character, of any window of a string (of the whole, if shorter)."""
    chars = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    n_log_n = lambda c: F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))
    width = F.least(F.length(value), F.lit(window))

    def step(a, x, at, out):
        """Counts and their sum after x enters and out leaves (null: none leaves)."""
        has, had = F.get(a["n"], x), F.get(a["n"], out)
        moved = out.isNotNull() & (out != x)
        entered = out.isNull() | moved
        total = (
            a["t"]
            + F.when(entered, n_log_n(has + 1) - n_log_n(has)).otherwise(F.lit(0.0))
            + F.when(moved, n_log_n(had - 1) - n_log_n(had)).otherwise(F.lit(0.0))
        )
        counts = F.transform(
            a["n"],
            lambda c, k: c
            + F.when(entered & (k == x), F.lit(1)).otherwise(F.lit(0))
            - F.when(moved & (k == out), F.lit(1)).otherwise(F.lit(0)),
        )
        bits = F.log2(width.cast("double")) - total / width
        return F.struct(
            (a["at"] + 1).cast("int").alias("at"),
            counts.alias("n"),
            total.cast("double").alias("t"),
            F.when(a["at"] + 1 >= width, F.greatest(a["best"], bits)).otherwise(a["best"]).cast("double").alias("best"),
        )

    start = F.struct(
        F.lit(0).alias("at"), F.array_repeat(F.lit(0), 128).alias("n"), F.lit(0.0).alias("t"), F.lit(0.0).alias("best")
    )
    pairs = F.transform(
        chars, lambda c, i: F.struct(c.alias("x"), F.when(i >= window, F.get(chars, i - window)).alias("out"))
    )
    return F.aggregate(pairs, start, lambda a, p: step(a, p["x"], a["at"], p["out"]), lambda a: a["best"])


def _suspicious(value: Column) -> Column:
    """Whether a candidate reaches its class's entropy and the allow-list does not explain it."""
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    high = F.lit(False)
    for c in reversed(CLASSES):
        high = F.when(value.rlike(c.pattern), best_entropy(value, c.window) >= c.bits).otherwise(high)
    return F.when(allowed, F.lit(False)).otherwise(high)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: doc_id and, for each kind, its spans (s, e, v)."""
    docs = df.select(df[id_col].alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    for kind, pattern in FORMS.items():
        docs = _located(docs, pattern, kind)
    docs = docs.withColumn(
        "assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["v"], FORMS["assign"], 2)) >= 6)
    ).withColumn("access", F.filter("access", lambda x: F.length(x["v"]) >= 20))
    docs = _located(docs, CANDIDATE, "runs").drop("text")
    # few texts have a candidate; only those pay for entropy
    known = F.concat(*FORMS)
    news = F.filter("runs", lambda x: ~F.exists(known, lambda y: (y["s"] <= x["s"]) & (x["e"] <= y["e"])))
    docs = docs.withColumn("runs", F.when(F.size("runs") > 0, news))
    found = F.when(F.size("runs") > 0, F.filter("runs", lambda x: _suspicious(x["v"])))
    return docs.withColumn(ENTROPY, F.coalesce(found, F.array().cast(_NO_SPANS))).drop("runs")


def _written(kind: str) -> Column:
    """(start, place of the kind, end, kind:start:end) of each span of a kind."""
    return F.transform(
        kind,
        lambda x: F.struct(
            x["s"].alias("s"),
            F.lit(KINDS.index(kind)).alias("i"),
            x["e"].alias("e"),
            F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")).alias("t"),
        ),
    )


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by start and then by the order of kinds."""
    ordered = F.array_sort(F.concat(*map(_written, kinds)))
    return F.array_join(F.transform(ordered, lambda x: x["t"]), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of a scan."""
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in FORMS),
        F.sha2(joined(tuple(FORMS)), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        F.size(ENTROPY).cast("long").alias("n_entropy"),
    )
