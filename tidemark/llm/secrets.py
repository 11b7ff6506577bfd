"""Secret scans with multipart credential linking (operator 6), native.

Base kinds (leftmost, non-overlapping, each kind on its own):

* ``assign``  a secret-like name, a separator and a value of 6 characters or more;
* ``access``  ``AKIA`` and upper-case letters or digits, 20 characters or more;
* ``hex``     24 or more lower-case hexadecimal digits.

A credential usually comes in parts: an access identifier, a secret, an
endpoint.  Each part alone is a weak sign, and reporting all of them would
flag ordinary text.  The linking step finds weak parts, puts each into the
*scope* it stands in (a stretch of text without a blank line) and joins parts
whose spans lie within ``WINDOW`` code points of each other in one scope.  A
weak part is reported only when a complementary part is near:

* ``ident`` and ``endpoint`` (weak) when a secret is near: ``assign``, ``hex``
  or ``token``;
* ``token`` (weak: 20 or more characters with upper case, lower case and a
  digit) when an identifier or endpoint is near: ``access``, ``ident``,
  ``endpoint``.

A weak part that overlaps a base span is part of that span and is left out.

Everything is DataFrame functions: spans come from the lengths of the pieces
between matches, running sums in a window turn them into positions, and the
interval join is an equi-join on (document, scope, block of positions) with
the exact distance as a condition.  Only matches are shuffled, never texts.

Defined cases: a null or empty text has no spans (empty digest of the empty
string); equal rows are scanned once and each gets the result; rows with a
null key are kept; an empty table gives an empty table; other columns are
left out; a text of any length is scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import read, split_by_keys, written

#: Fixed patterns of the base kinds, in report order.
ASSIGN_NAME = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
)
ASSIGN_HEAD = ASSIGN_NAME + r"""["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = "([A-Za-z0-9+/_.=-]+)"
BASE = {
    "assign": ASSIGN_HEAD + ASSIGN_VALUE,
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
#: Weak parts, in report order after the base kinds.
WEAK = {
    "ident": r"""(?:[aA][cC][cC][eE][sS][sS]_?[kK][eE][yY](?:_?[iI][dD])?|[cC][lL][iI][eE][nN][tT]_?[iI][dD]"""
    r"""|[uU][sS][eE][rR](?:_?[nN][aA][mM][eE])?|[lL][oO][gG][iI][nN]|[aA][cC][cC][oO][uU][nN][tT])"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""",
    "endpoint": r"""[a-zA-Z][a-zA-Z0-9+.-]{1,20}://[^\x20\x09-\x0D"'<>]+""",
    "token": "[A-Za-z0-9+/_-]{20,}",
}
KINDS = [*BASE, *WEAK]
#: How far apart, in code points, two parts of one credential may stand.
WINDOW = 200
#: A scope ends at a blank line.
SCOPE_END = r"\x0A[\x20\x09\x0D]*\x0A"


def _matches(text: Column, pattern: str) -> Column:
    """Array of (gap, len, word): for each match the code points since the end
    of the match before, those of the match, and the match itself."""
    # zipped, so that the pieces are made once and not again for each match; the
    # piece after the last match has no match beside it
    both = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("word"),
        F.split(text, pattern, -1).alias("gap"),
    )
    return F.when(
        text.rlike(pattern),
        F.transform(
            F.filter(both, lambda m: m["word"].isNotNull()),
            lambda m: F.struct(
                F.char_length(m["gap"]).cast("long").alias("gap"),
                F.char_length(m["word"]).cast("long").alias("len"),
                m["word"].alias("word"),
            ),
        ),
    )


def _found(docs: DataFrame) -> DataFrame:
    """One row per match of any pattern: row key, kind, start, end, word."""
    t = F.col("_text")
    # a word of 20 characters is common, so tokens are looked for only where a
    # part they could belong to occurs at all; likewise the other weak kinds
    partner = t.rlike("|".join([BASE["access"], WEAK["ident"], WEAK["endpoint"]]))
    scan = {k: _matches(t, p) for k, p in BASE.items() if k != "hex"}
    # shorter runs are ordinary words; a run is found whole either way
    scan["hex"] = _matches(t, "[0-9a-f]{24,}")
    scan |= {k: F.when(partner, _matches(t, p)) for k, p in WEAK.items()}
    scan["break"] = F.when(partner, _matches(t, SCOPE_END))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), m.alias("ms")) for k, m in scan.items()])
    rows = (
        docs.select("_id", "_sum", F.filter(kinds, lambda k: F.size(k["ms"]) > 0).alias("ks"))
        .where(F.size("ks") > 0)
        .dropDuplicates(["_id", "_sum"])
        .select("_id", "_sum", F.explode("ks").alias("k"))
        .select("_id", "_sum", F.col("k.kind").alias("kind"), F.posexplode("k.ms").alias("pos", "m"))
    )
    run = W.partitionBy("_id", "_sum", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.col("m.len")).over(run)
    return rows.select(
        "_id", "_sum", "kind", (end - F.col("m.len")).alias("start"), end.alias("end"), F.col("m.word").alias("word")
    )


def _valid(kind: Column, word: Column) -> Column:
    value = F.regexp_replace(word, "^" + ASSIGN_HEAD, "")
    return (
        F.when(kind == "assign", F.char_length(value) >= 6)
        .when(kind == "access", F.char_length(word) >= 20)
        .when(
            kind == "token",
            word.rlike("[A-Z]") & word.rlike("[a-z]") & word.rlike("[0-9]"),
        )
        .otherwise(F.lit(True))
    )


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(_id, _sum, kind, start, end) of every reported span: one row per span
    of each different (key, text); ``_sum`` is a digest of the text."""
    return _reported(_found(_keyed(docs, key, text)), window)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_id"),
        F.xxhash64(whole).alias("_sum"),
        whole.alias("_text"),
    )


def _reported(found: DataFrame, window: int) -> DataFrame:
    doc = ["_id", "_sum"]
    rows = found.where(_valid(F.col("kind"), F.col("word"))).drop("word")
    is_base = F.col("kind").isin(*BASE)
    # running frames from either side: a frame that only grows costs a step a row
    until = W.partitionBy(*doc).orderBy("start").rangeBetween(W.unboundedPreceding, 0)
    after = W.partitionBy(*doc).orderBy(F.desc("start")).rangeBetween(W.unboundedPreceding, 0)
    placed = (
        rows.withColumn("scope", F.sum(F.when(F.col("kind") == "break", 1).otherwise(0)).over(until))
        .withColumn("base_end", F.max(F.when(is_base, F.col("end"))).over(until))
        .withColumn("base_start", F.min(F.when(is_base, F.col("start"))).over(after))
        .where(F.col("kind") != "break")
        .withColumn(
            "covered",
            ~is_base
            & (
                F.coalesce(F.col("base_end") > F.col("start"), F.lit(False))
                | F.coalesce(F.col("base_start") < F.col("end"), F.lit(False))
            ),
        )
        .where(~F.col("covered"))
        .select(*doc, "kind", "start", "end", "scope", is_base.alias("base"))
    )
    weak = placed.where(~F.col("base")).select(
        *doc, "kind", "start", "end", "scope", F.floor(F.col("start") / window).alias("block")
    )
    # a part reaches every block of positions that its widened interval touches
    parts = placed.select(
        F.col("_id").alias("p_id"),
        F.col("_sum").alias("p_sum"),
        F.col("kind").alias("p_kind"),
        F.col("start").alias("p_start"),
        F.col("end").alias("p_end"),
        F.col("scope").alias("p_scope"),
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("start") - window, F.lit(0)) / window),
                F.floor((F.col("end") + window) / window),
            )
        ).alias("p_block"),
    )
    secret = F.col("p_kind").isin("assign", "hex", "token")
    partner = F.col("p_kind").isin("access", "ident", "endpoint")
    near = (
        (F.col("_id") == F.col("p_id"))
        & (F.col("_sum") == F.col("p_sum"))
        & (F.col("scope") == F.col("p_scope"))
        & (F.col("block") == F.col("p_block"))
        & (F.col("start") >= F.col("p_start") - window)
        & (F.col("start") <= F.col("p_end") + window)
        & F.when(F.col("kind") == "token", partner).otherwise(secret)
    )
    linked = weak.join(parts, near, "left_semi").select(*doc, "kind", "start", "end")
    return placed.where("base").select(*doc, "kind", "start", "end").unionByName(linked)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: key, span counts and joined spans."""
    keyed = _keyed(docs, key, text)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    told = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base_told = F.array_join(
        F.transform(
            F.filter("s", lambda x: x["rank"] <= len(BASE)),
            lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]),
        ),
        ",",
    )
    count = lambda k: F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"n_{k}")
    per_doc = (
        _reported(_found(keyed), window)
        .groupBy("_id", "_sum")
        .agg(
            *map(count, KINDS),
            F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind"))).alias("s"),
        )
        .select("_id", "_sum", *[f"n_{k}" for k in KINDS], base_told.alias("base"), told.alias("spans"))
    )
    zero = lambda k: F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}")
    return (
        keyed.select("_key", "_id", "_sum")
        .join(per_doc, ["_id", "_sum"], "left")
        .select(
            F.col("_key").alias(key),
            *map(zero, BASE),
            F.sha2(F.coalesce(F.col("base"), F.lit("")).cast("binary"), 256).alias("base_sha256"),
            F.coalesce(F.col("spans"), F.lit("")).alias("spans"),
            *map(zero, WEAK),
        )
    )


#: What stands for a secret in redacted text.
MASK = "[secret]"


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, mask: str = MASK) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mask``
    (overlapping spans by one); all other columns as they are.  Only texts
    that may hold a secret are shuffled."""
    rows = docs.select(
        F.struct(*docs.columns).alias("_all"),
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_sum"),
    )
    doc = ["_id", "_sum"]
    before = W.partitionBy(*doc).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    # what is kept of a text: a piece before each span that no span before it
    # overlaps, and what follows the last one
    cuts = spans(docs, key, text, window).withColumn("at", F.coalesce(F.max("end").over(before), F.lit(0)))
    found = written(
        cuts.groupBy(*doc).agg(
            F.sort_array(F.collect_list(F.when(F.col("start") >= F.col("at"), F.struct("start", "at")))).alias("_pieces"),
            F.max("end").alias("_tail"),
        ),
        "spans",
    )
    clean, some = split_by_keys(rows, found, doc)
    t = F.col("_all")[text]

    def told_with_mask(whole):
        # four bytes a code point, so that a piece is found by its place
        piece = lambda at, size: F.decode(F.substring(whole, at.cast("int"), size.cast("int")), "UTF-32")
        kept = F.transform("_pieces", lambda p: piece(4 * p["at"] + 1, 4 * (p["start"] - p["at"])))
        return F.array_join(F.concat(kept, F.array(piece(4 * F.col("_tail") + 1, F.length(whole)))), mask)

    # the encoded text is bound once as the element of an array
    masked = F.transform(F.array(F.encode(t, "UTF-32")), told_with_mask)[0]
    some = some.join(found, ["_id", "_sum"], "left")
    told = F.when(F.col("_pieces").isNull(), t).otherwise(masked).alias(text)
    some = some.select(*[told if c == text else F.col("_all")[c].alias(c) for c in docs.columns])
    return clean.select("_all.*").unionByName(some)


def q_op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return scan(read(spark, sf_dir, "documents"))


def _sql() -> str:
    """DuckDB twin, from the same patterns."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    partner = quote("|".join([BASE["access"], WEAK["ident"], WEAK["endpoint"]]))
    patterns = BASE | {"hex": "[0-9a-f]{24,}"} | WEAK | {"break": SCOPE_END}
    found = " UNION ALL ".join(
        f"""SELECT d, '{k}' AS kind, unnest(regexp_extract_all(t, {quote(p)})) AS word,
              unnest(string_split_regex(t, {quote(p)})[:-2]) AS gap,
              generate_subscripts(regexp_extract_all(t, {quote(p)}), 1) AS pos
            FROM docs WHERE regexp_matches(t, {quote(p)})"""
        + ("" if k in BASE else f" AND regexp_matches(t, {partner})")
        for k, p in patterns.items()
    )
    rank = "list_position([" + ", ".join(map(quote, KINDS)) + "], kind)"
    base = "kind IN (" + ", ".join(map(quote, BASE)) + ")"
    told = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, " + rank + ")"
    counts = lambda ks: ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ks)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (SELECT d, kind, word, sum(length(gap) + length(word)) OVER (PARTITION BY d, kind ORDER BY pos) AS e FROM found),
valid AS (SELECT d, kind, e - length(word) AS s, e FROM placed WHERE CASE kind
    WHEN 'assign' THEN length(regexp_replace(word, {quote("^" + ASSIGN_HEAD)}, '')) >= 6
    WHEN 'access' THEN length(word) >= 20
    WHEN 'token' THEN regexp_matches(word, '[A-Z]') AND regexp_matches(word, '[a-z]') AND regexp_matches(word, '[0-9]')
    ELSE true END),
scoped AS (SELECT v.*, (SELECT count(*) FROM valid b WHERE b.d = v.d AND b.kind = 'break' AND b.s <= v.s) AS scope
    FROM valid v WHERE kind <> 'break'),
parts AS (SELECT * FROM scoped v WHERE {base} OR NOT EXISTS (SELECT 1 FROM scoped b WHERE b.d = v.d AND b.{base} AND b.s < v.e AND b.e > v.s)),
spans AS (SELECT * FROM parts c WHERE {base} OR EXISTS (SELECT 1 FROM parts p WHERE p.d = c.d AND p.scope = c.scope
    AND c.s >= p.s - {WINDOW} AND c.s <= p.e + {WINDOW}
    AND CASE WHEN c.kind = 'token' THEN p.kind IN ('access', 'ident', 'endpoint') ELSE p.kind IN ('assign', 'hex', 'token') END)),
per AS (SELECT d, {counts(KINDS)}, {told} FILTER ({base}) AS base, {told} AS spans FROM spans GROUP BY d)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in WEAK)}
FROM docs LEFT JOIN per USING (d)
"""


QUERIES = {"op6_secret_scan": q_op6_secret_scan}
ORACLE_SQL = {"op6_secret_scan": _sql()}
