"""Document fingerprints as Merkle trees (operator 9), native.

The tree of a text has four levels: root, sections (split at every ``\\n\\n``),
paragraphs (a section split at every ``\\n``) and leaves (runs of a paragraph
up to the end of a sentence, at most ``LEAF`` code points each).  Every split
is exact, so the leaves in order give the text back; each node's hash is taken
over its children's full hashes, so equal texts have equal roots and the other
way round (up to collisions of MD5).  The fingerprint writes the tree down:

    root|section(paragraph:leaf,leaf paragraph:leaf,...);section(...)

with the full root hash and the first 16 or 8 hex digits of the other nodes.
Roots test equality; where they differ, equal section and paragraph hashes
close their branches and the rest locate the edit (``differing``).  The
likeness of two trees is 1 for equal roots, else the Dice coefficient of
their distinct leaf hashes.

Everything is DataFrame functions.  The next document of each document is
found by one window over ranges of ids (integers): ranges are cut at quantiles of
the ids, so they hold about equally many rows however the ids lie, and the first
document of each range is also handed to the range before, so no range has to
know its neighbour.

Defined cases: a null text counts as empty; the empty text has a tree of one
empty section; rows that share an id each get the same successor, the document
with the next larger id (of several with that id, the smallest text); a row
with a null id has no successor, so its tail is replaced by nothing and its
``near_next`` is null; a single id is its own successor; an empty table gives
an empty table; other columns are left out; long texts are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import read

#: Code points of the longest leaf.
LEAF = 64
#: Sentence runs: text up to its closing marks, cut at LEAF code points.
LEAF_PATTERN = r"[^.!?]{1,%d}[.!?]*|[.!?]+" % LEAF
#: Rows that a range of ids aims at, cells by which rows find their range, and how
#: many ranges there may be (beyond it ranges get more rows; ranges and their first
#: ids are broadcast, so their number is bounded).
RANGE_ROWS = 2000
CELLS = 4096
MAX_RANGES = 16384


def fingerprint(text: Column) -> Column:
    """The written tree of a text."""
    tree = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n\n", -1),
        lambda section: _section(F.transform(F.split(section, "\n", -1), _paragraph)),
    )
    written = lambda t: F.concat(
        F.md5(F.concat(F.lit("r"), F.array_join(F.transform(t, lambda s: s["hash"]), ""))),
        F.lit("|"),
        F.array_join(F.transform(t, lambda s: s["told"]), ";"),
    )
    # a one-element array binds the tree, so that it is computed once
    return F.element_at(F.transform(F.array(tree), written), 1)


def _paragraph(paragraph: Column) -> Column:
    leaves = F.transform(F.regexp_extract_all(paragraph, F.lit(f"({LEAF_PATTERN})"), F.lit(1)), lambda x: F.md5(x))
    bound = F.transform(
        F.array(leaves),
        lambda ls: F.struct(
            F.md5(F.concat(F.lit("p"), F.array_join(ls, ""))).alias("hash"),
            F.array_join(F.transform(ls, lambda x: F.substring(x, 1, 8)), ",").alias("leaves"),
        ),
    )
    return F.element_at(bound, 1)


def _section(paragraphs: Column) -> Column:
    return F.element_at(
        F.transform(
            F.array(paragraphs),
            lambda ps: F.element_at(
                F.transform(
                    F.array(F.md5(F.concat(F.lit("s"), F.array_join(F.transform(ps, lambda p: p["hash"]), "")))),
                    lambda h: F.struct(
                        h.alias("hash"),
                        F.concat(
                            F.substring(h, 1, 16),
                            F.lit("("),
                            F.array_join(
                                F.transform(ps, lambda p: F.concat(F.substring(p["hash"], 1, 16), F.lit(":"), p["leaves"])),
                                " ",
                            ),
                            F.lit(")"),
                        ).alias("told"),
                    ),
                ),
                1,
            ),
        ),
        1,
    )


def root(tree: Column) -> Column:
    return F.substring(tree, 1, 32)


def leaves(tree: Column) -> Column:
    """Distinct leaf hashes of a written tree."""
    return F.array_distinct(F.regexp_extract_all(tree, F.lit("[:,]([0-9a-f]{8})"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; null where either tree is null."""
    dice = F.element_at(
        F.transform(
            F.array(F.struct(leaves(a).alias("a"), leaves(b).alias("b"))),
            lambda x: F.try_divide(
                F.lit(2.0) * F.size(F.array_intersect(x["a"], x["b"])), F.size(x["a"]) + F.size(x["b"])
            ),
        ),
        1,
    )
    return F.when(a.isNull() | b.isNull(), None).when(root(a) == root(b), 1.0).otherwise(F.coalesce(dice, F.lit(0.0)))


def differing(a: Column, b: Column) -> Column:
    """Paragraph branches of tree ``a`` (section number, paragraph number,
    hash, both numbers from 0) that tree ``b`` doesn't have; sections whose
    hashes ``b`` has are closed without looking into them."""
    sections = lambda t: F.split(F.substring_index(t, "|", -1), ";", -1)
    known = F.transform(sections(b), lambda s: F.substring(s, 1, 16))
    known_paragraphs = F.regexp_extract_all(b, F.lit("([0-9a-f]{16}):"), F.lit(1))
    open_paragraphs = F.transform(
        sections(a),
        lambda s, i: F.when(
            F.array_contains(known, F.substring(s, 1, 16)), F.array().cast("array<struct<section:int,paragraph:int,hash:string>>")
        ).otherwise(
            F.filter(
                F.transform(
                    F.regexp_extract_all(s, F.lit("([0-9a-f]{16}):"), F.lit(1)),
                    lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), p.alias("hash")),
                ),
                lambda p: ~F.array_contains(known_paragraphs, p["hash"]),
            )
        ),
    )
    return F.when(root(a) == root(b), F.array().cast("array<struct<section:int,paragraph:int,hash:string>>")).otherwise(
        F.flatten(open_paragraphs)
    )


def _ranged(rows: DataFrame, size: int, cells: int) -> DataFrame:
    """``rows`` with the range of their ``_id``: consecutive ranges of about
    ``size`` rows each, cut at quantiles of the ids.  A small table tells each
    range in every one of ``cells`` cells of equal width that it touches; rows
    meet it by their cell, and each id lies in one range.

    Two small jobs read the ids only.  What reaches the driver, and the table,
    are bounded by ``cells`` and MAX_RANGES."""
    ids = rows.select("_id")
    n, lo, hi = ids.agg(F.count("*"), F.min("_id"), F.max("_id")).first()
    if not n:
        return rows.withColumn("_range", F.lit(0))
    ranges = min(MAX_RANGES, -(-n // size))
    cuts: list[int] = []
    if ranges > 1:
        shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
        cuts = sorted({*ids.agg(F.percentile_approx("_id", shares, max(10_000, 20 * ranges))).first()[0]})
    cuts = [int(c) for c in cuts if c < hi]
    lo, hi = int(lo), int(hi)
    width = (hi - lo) // cells + 1
    told = [
        (cell, start, end, r)
        for r, (start, end) in enumerate(zip([lo, *[c + 1 for c in cuts]], [*cuts, hi], strict=True))
        for cell in range((start - lo) // width, (end - lo) // width + 1)
    ]
    table = F.broadcast(rows.sparkSession.createDataFrame(told, "_cell int, _from long, _to long, _range int"))
    # whole-number division; the differences of unbounded ids are taken in decimals
    wide = lambda x: f"cast({x} as decimal(20,0))"
    cell = F.expr(f"({wide('_id')} - {wide(lo)}) div {wide(width)}")
    inside = (F.col("_id") >= F.col("_from")) & (F.col("_id") <= F.col("_to"))
    return rows.join(table, (cell == F.col("_cell")) & inside).drop("_cell", "_from", "_to")


def edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited, fingerprint, next_fingerprint): each text's tree,
    its successor's tree, and the text with its last quarter replaced by the
    beginning of its successor."""
    base = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    own = base.where(F.col("_id").isNotNull())
    own = _ranged(own, RANGE_ROWS, CELLS)
    ids = own.select("_id", "_range")
    # the first id of each range, and the range before it (the last one's for
    # the very first): at most one row per range
    firsts = ids.groupBy("_range").agg(F.min("_id").alias("_id"))
    over = W.orderBy("_range")
    ring = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    guests = firsts.select(
        "_id",
        F.coalesce(F.lag("_range").over(over), F.max("_range").over(ring)).alias("_range"),
        F.lag("_range").over(over).isNull().alias("_wraps"),
    )
    known = own.select("_id", "_text", fingerprint(F.col("_text")).alias("_tree"), "_range")
    visiting = own.drop("_range").join(F.broadcast(guests), "_id").select(
        "_id",
        "_text",
        fingerprint(F.col("_text")).alias("_tree"),
        "_range",
        F.when(F.col("_wraps"), 2).otherwise(1).alias("_guest"),
    )
    placed = known.withColumn("_guest", F.lit(0)).unionByName(visiting)
    over = "over (partition by _range order by _guest = 2, _id, _text)"
    # the rows of an id stand together, the first of them stands for it
    follow = (
        placed.withColumn("_first", F.expr(f"not coalesce(lag(_id) {over} = _id and lag(_guest) {over} = _guest, false)"))
        .withColumn("_next", F.expr(f"lead(if(_first, named_struct('text', _text, 'tree', _tree), null)) ignore nulls {over}"))
        .where("_guest = 0")
    )
    rows = follow.unionByName(
        base.where(F.col("_id").isNull()).withColumn("_tree", fingerprint(F.col("_text"))), allowMissingColumns=True
    )
    n = F.char_length("_text")
    tail = F.floor(n / 4).cast("int")
    return rows.select(
        F.col("_id").alias(key),
        n.cast("long").alias("n_chars"),
        F.concat(
            F.expr("substring(_text, 1, char_length(_text) - cast(floor(char_length(_text) / 4) as int))"),
            F.coalesce(F.substring(F.col("_next.text"), F.lit(1), tail), F.lit("")),
        ).alias("edited"),
        F.col("_tree").alias("fingerprint"),
        F.col("_next.tree").alias("next_fingerprint"),
    )


def q_op9_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of every whole text of ``documents`` and of its edited form."""
    rows = edits(read(spark, sf_dir, "documents")).withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _sql() -> str:
    """DuckDB twin."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    dice = lambda a, b: (
        f"CASE WHEN left({a}.tree, 32) = left({b}.tree, 32) THEN 1.0::DOUBLE"
        f" WHEN len({a}.leaves) + len({b}.leaves) = 0 THEN 0.0::DOUBLE"
        f" ELSE 2.0::DOUBLE * len(list_intersect({a}.leaves, {b}.leaves)) / (len({a}.leaves) + len({b}.leaves)) END"
    )
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
nexts AS (SELECT doc_id, t, n, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
    coalesce(lead(t) OVER w, first_value(t) OVER w) AS next_t FROM docs WINDOW w AS (ORDER BY doc_id)),
texts AS (SELECT doc_id, 'own' AS kind, t FROM nexts
    UNION ALL SELECT doc_id, 'edited', left(t, n - n // 4) || left(next_t, n // 4) FROM nexts),
hashed AS (SELECT doc_id, kind, t, list_transform(string_split(t, chr(10) || chr(10)),
    lambda s: list_transform(string_split(s, chr(10)),
    lambda p: list_transform(regexp_extract_all(p, {quote(LEAF_PATTERN)}), lambda x: md5(x)))) AS leaf FROM texts),
paragraphs AS (SELECT doc_id, kind, t, leaf, list_transform(leaf, lambda s: list_transform(s,
    lambda p: md5('p' || array_to_string(p, '')))) AS par FROM hashed),
sections AS (SELECT *, list_transform(par, lambda s: md5('s' || array_to_string(s, ''))) AS sec FROM paragraphs),
trees AS (SELECT doc_id, kind, t, md5('r' || array_to_string(sec, '')) || '|' || array_to_string(list_transform(range(1, len(sec) + 1),
    lambda i: left(sec[i], 16) || '(' || array_to_string(list_transform(range(1, len(par[i]) + 1),
    lambda j: left(par[i][j], 16) || ':' || array_to_string(list_transform(leaf[i][j], lambda x: left(x, 8)), ',')), ' ') || ')'), ';') AS tree,
    list_distinct(list_transform(flatten(flatten(leaf)), lambda x: left(x, 8))) AS leaves FROM sections)
SELECT x.doc_id, x.n::BIGINT AS n_chars, sha256(e.t) AS edited_sha256, o.tree AS fingerprint, e.tree AS edited_fingerprint,
  {dice("o", "e")} AS near_edited, {dice("o", "f")} AS near_next
FROM nexts x JOIN trees o ON o.doc_id = x.doc_id AND o.kind = 'own' JOIN trees e ON e.doc_id = x.doc_id AND e.kind = 'edited'
  JOIN trees f ON f.doc_id = x.next_id AND f.kind = 'own'
"""


QUERIES = {"op9_merkle_fingerprint": q_op9_merkle_fingerprint}
ORACLE_SQL = {"op9_merkle_fingerprint": _sql()}
