"""Quality rules: cross-document line frequency, DataFrame functions only.

A host repeats its boilerplate (licence lines, notices, calls to subscribe)
in many documents. Lines are normalised and hashed, every line's distinct
documents are counted per host, lines above the limits are removed, and a
document that loses most of its words is rejected.

A copied document must not look like boilerplate: all its lines recur, but
always together. Exact copies (documents of the same lines) count once. Near
copies are told by *family*: every line has two marks, its alphabetically first and
last three-word window, and the family is the first and the last window of all the
document's other lines. A small edit rarely touches either, as each stands for all
windows of the document, so near copies fall into few families for their number;
documents that have words of their own beside a common line do not. A line is
boilerplate if it has more than ``max_docs`` families and those are at
least ``min_family_share`` of its distinct documents. So documents that are alike in
all but a twelfth of their words or less count as near copies, whatever lines they share.

Scale: one scan for the per-document figures, all inside the row; one scan for
the line hashes, written to the checkpoint folder as both the counts and the
removal need them; one exchange of line hashes with map-side counts (a line that a third
of all documents hold is one row per map task), which leaves the lines of more than
``max_docs`` occurrences; one equi-join of line occurrences with those, whose hot keys
AQE splits; the families of these few lines by grouped counts; one join
back on document keys. Texts are shuffled only if ``clean_text`` is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.llm.common import BLANKS, LOWER, UPPER, ascii_lower, dealt_anew, durable, let, pick, words

SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"


#: One pass over a line: case folded, digits alike, blanks gone.
FOLD_FROM = UPPER + "0123456789" + BLANKS
FOLD_TO = LOWER + "0000000000"


def _hash(text: Column) -> Column:
    """60-bit hash of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _marks(w: Column) -> Column:
    """(lo, hi): the alphabetically first and last three-word window of the words, or all words if they are fewer.

    A mark is a number in alphabetical order: the window's first five bytes, then 20 bits of its hash.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c")))
    joined = lambda x: F.concat_ws(" ", x["a"], x["b"], x["c"])

    def number(text: Column) -> Column:
        return let(text.cast("binary"), lambda b: F.conv(F.concat(F.rpad(F.hex(F.substring(b, 1, 5)), 10, "0"), F.substring(F.md5(b), 1, 5)), 16, 10).cast("long"))

    ends = let(windows, lambda x: F.struct(number(joined(F.array_min(x))).alias("lo"), number(joined(F.array_max(x))).alias("hi")))
    short = let(number(F.array_join(w, " ")), lambda n: F.struct(n.alias("lo"), n.alias("hi")))
    return F.when(F.size(w) < 3, short).otherwise(ends)


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``w``.

    Windows are compared by a 64-bit hash, within one document only.
    """
    def windows(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(v) - 3), lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))

    def starts(marked: Column) -> Column:
        """Positions of the windows whose neighbour in hash order is alike."""
        alike = lambda x, j: F.coalesce(F.get(marked, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(marked, lambda x, j: alike(x, j - 1) | alike(x, j + 1)), lambda x: x["i"]))

    def covered(h: Column) -> Column:
        marked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.aggregate(
            let(marked, starts), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"), (p + 3).alias("end")),
            lambda acc: acc["n"])

    def spread(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(let(w, windows), spread)).cast("long")


def line_rules(docs: DataFrame, max_docs: int = 10, min_family_share: float = 0.15, max_removed_share: float = 0.5,
               min_words: int = 50, max_repeat_pct: int = 50, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): figures, verdict, clean text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, removed_words, removed_lines,
    text, clean_text, and ``carried``, a struct of the columns that ``carry``
    names. ``clean_text`` is the text without its
    boilerplate lines (the very text if it has none).

    Null text: no words, ``base_failed``, clean_text null; empty text alike.
    Null source: a host of its own. Null or repeated doc_id: every row is a
    document and gets its own result; rows equal in doc_id, source and text
    get equal results. Very long texts are worked on whole, inside their row.
    An empty table gives an empty result. Extra columns are ignored.
    """
    base = pick(docs, **{c: "string" for c in ("text", "source", *carry)} | {"doc_id": "long"}).select(
        "doc_id", "text", F.xxhash64("source", F.col("source").isNull(), "text", F.col("text").isNull()).alias("row_hash"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("host"),
        F.struct(*(carry or [F.lit(None).alias("none")])).alias("carried"))
    full = F.coalesce(F.col("text"), F.lit(""))
    lines = base.select("doc_id", "row_hash", "host", F.split(full, "\n").alias("lines"))
    keyed = durable(lines.select("doc_id", "row_hash", "host", F.transform("lines", lambda x: let(
        F.translate(x, FOLD_FROM, FOLD_TO), lambda folded: F.when(folded != "", let(words(ascii_lower(x)), lambda w: F.struct(
            _hash(folded).alias("key"), F.size(w).alias("words"), _marks(w).alias("marks")))))).alias("lines")))

    real = F.filter("lines", lambda x: x.isNotNull())
    ordered = lambda end: F.sort_array(F.array_distinct(F.transform(real, lambda x: F.struct(x["marks"][end].alias("mark"), x["key"].alias("key")))))
    often = keyed.select("host", F.explode(F.transform(real, lambda x: x["key"])).alias("key")).groupBy("host", "key").agg(F.count("*").alias("rows"))
    often = dealt_anew(often.where(F.col("rows") > max_docs), "rows", "host", "key").drop("rows")
    own = keyed.select("doc_id", "row_hash", "host", "lines", ordered("lo").alias("lows"), ordered("hi").alias("highs")).select(
        "doc_id", "row_hash", "host", F.xxhash64(F.sort_array(F.transform("lows", lambda x: x["key"]))).alias("doc"),
        F.get("lows", F.lit(0)).alias("a0"), F.get("lows", F.lit(1)).alias("a1"),
        F.get("highs", F.size("highs") - 1).alias("z0"), F.get("highs", F.size("highs") - 2).alias("z1"), F.posexplode("lines").alias("pos", "line"))
    other = lambda here, there: F.when(F.col("line.key") == F.col(f"{here}.key"), F.col(f"{there}.mark")).otherwise(F.col(f"{here}.mark"))
    common = durable(own.where(F.col("line").isNotNull()).select(
        "doc_id", "row_hash", "host", "pos", F.col("line.key").alias("key"), F.col("line.words").alias("words"), "doc",
        F.xxhash64(F.coalesce(other("a0", "a1"), F.lit(-1)), F.coalesce(other("z0", "z1"), F.lit(-1))).alias("family")).join(often, ["host", "key"]))
    families = (
        common.groupBy("host", "key", "family", "doc").agg(F.lit(1).alias("one"))
        .groupBy("host", "key", "family").agg(F.count("*").alias("docs"))
        .groupBy("host", "key").agg(F.count("*").alias("families"), F.sum("docs").alias("docs")))
    boilerplate = dealt_anew(families.where(
        (F.col("families") > max_docs) & (F.col("families") >= min_family_share * F.col("docs"))), "docs", "host", "key").select("host", "key")

    found = (
        common.select("doc_id", "row_hash", "host", "pos", "key", "words").join(boilerplate, ["host", "key"])
        .groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("pos", "words")).alias("removed"))
        .select(F.col("doc_id").alias("id"), F.col("row_hash").alias("hash"), "removed"))

    w, ws = F.col("w"), F.col("with_word")
    figures = (
        base.withColumn("w", words(F.col("text")))
        .withColumn("with_word", F.filter(F.split(full, "\n"), lambda x: x.rlike(HAS_WORD)))
        .select(
            "doc_id", "row_hash", "text", "carried",
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(full, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(full) - F.length(F.translate(full, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(ws) - F.size(F.array_distinct(ws))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words")))
    none = F.array().cast("array<struct<pos:int,words:int>>")
    judged = (
        figures.join(found, figures["doc_id"].eqNullSafe(found["id"]) & (figures["row_hash"] == found["hash"]), "left")
        .withColumn("gone", F.coalesce(F.col("removed"), none))
        .withColumn("removed_words", F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["words"]))
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))))
    stay = F.array_except(F.sequence(F.lit(0), F.size(F.split("text", "\n")) - 1), F.transform("gone", lambda x: x["pos"]))
    split = F.split(F.col("text"), "\n")
    clean = F.when(F.size("gone") == 0, F.col("text")).otherwise(
        let(split, lambda all_lines: F.array_join(F.transform(stay, lambda p: F.get(all_lines, p)), "\n")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("removed_words") <= max_removed_share * F.col("n_words"))).alias("kept"),
        "removed_words", F.size("gone").cast("long").alias("removed_lines"), "text", clean.alias("clean_text"), "carried")


def keep_clean(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, with clean texts and the columns of
    ``documents``; n_chars is counted anew. A text is shuffled once."""
    return line_rules(docs, carry=("lang", "source"), **limits).where("kept").select(
        "doc_id", F.col("clean_text").alias("text"), "carried.lang", "carried.source", F.length("clean_text").cast("long").alias("n_chars"))


#: DuckDB form of the op1 query.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS host FROM documents
), w AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, t, host FROM d
), grams AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), gram AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM grams
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM gram WHERE c > 1) GROUP BY doc_id
), split AS (
  SELECT doc_id, host, l, regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), line AS (
  SELECT doc_id, host, l, len(ws) AS n,
    CAST('0x' || substr(md5(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789' || chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13),
      'abcdefghijklmnopqrstuvwxyz0000000000')), 1, 15) AS BIGINT) AS key,
    CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
      ELSE array_to_string(list_min(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])), ' ') END AS lo,
    CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
      ELSE array_to_string(list_max(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])), ' ') END AS hi
  FROM split
), uniq AS (
  SELECT DISTINCT doc_id, host, key, CAST('0x' || rpad(substr(hex(encode(lo)), 1, 10), 10, '0') || substr(md5(lo), 1, 5) AS BIGINT) AS lo,
    CAST('0x' || rpad(substr(hex(encode(hi)), 1, 10), 10, '0') || substr(md5(hi), 1, 5) AS BIGINT) AS hi FROM line
), same AS (
  SELECT doc_id, list(DISTINCT key ORDER BY key) AS lines FROM uniq GROUP BY doc_id
), fam AS (
  SELECT u.doc_id, u.host, u.key, s.lines, min(o.lo) AS f, max(o.hi) AS z
  FROM uniq u JOIN same s ON s.doc_id = u.doc_id LEFT JOIN uniq o ON u.doc_id = o.doc_id AND u.key <> o.key GROUP BY ALL
), boiler AS (
  SELECT host, key FROM (SELECT host, key, count(DISTINCT lines) AS docs, count(DISTINCT {f: f, z: z}) AS families FROM fam GROUP BY host, key)
  WHERE families > 10 AND families >= 0.15 * docs
), gone AS (
  SELECT doc_id, sum(n) AS removed_words, count(*) AS removed_lines FROM line JOIN boiler USING (host, key) GROUP BY doc_id
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n_dup_lines FROM line GROUP BY doc_id
), figures AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words, CAST(coalesce(removed_lines, 0) AS BIGINT) AS removed_lines
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept,
  removed_words, removed_lines
FROM figures
"""


def query(spark, sf_dir: str) -> DataFrame:
    from dimfold.llm.common import read

    return line_rules(read(spark, sf_dir, "documents")).drop("text", "clean_text", "carried")
