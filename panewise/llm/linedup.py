"""Line dedup by a deletion-neighbourhood join; DataFrame functions only.

A line is its sequence of words (runs of characters other than ASCII white space); lines
without words are not looked at. Occurrences are ordered by document id, then line number.
An occurrence is removed if an earlier occurrence has the same line, or a line at an
edit distance of one word (one word inserted, deleted or replaced), if both lines have at least
``MIN_WORDS`` words. The earliest such occurrence is reported and stays.

1. Equal lines become one, with their first occurrence.
2. Lines within one edit have an equal beginning or an equal end (a power of two of words, up to
   half of the shorter line), so lines that share neither with any other line need no variants and go no further.
3. The rest emit their deletion neighbourhood as hashed keys: the line itself and the
   line without each of its words. Prefix hashes make that linear in the length of a line.
   Two lines that lack the same place and are equal otherwise differ by a replacement; a
   line that equals another one without a word, by an insertion. Within the lines of one key it is enough to
   know the earliest, so keys are aggregated and no pairs are listed, however many lines share a key.
4. The words of each line and of its earliest neighbour are compared.

Null or empty texts have no lines. A null id counts as larger than all others. Rows
that repeat an id have the same places, so they do not remove each other's lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panewise.llm.common import written

MIN_WORDS = 8
NO_ID = (1 << 63) - 1
#: Rows of three numbers (about 100 bytes in the hash table) that may be broadcast; beyond, Spark shuffles both sides.
BROADCAST_ROWS = 250_000
_BLANKS = "[ \\t\\x0B\\f\\r]+"


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(line, _BLANKS), "")


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, no, line) of every line; tag tells rows with one id apart."""
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    lines = rows.select("id", F.xxhash64("text").alias("tag"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return lines.select("id", "tag", (F.col("no") + 1).alias("no"), "line")


def _ends(min_words: int) -> Column:
    """Keys of the first and of the last ``size`` words, for ``size`` the largest power of two up to half of n words,
    and up to half of n - 1 words, as the longer of a pair: one edit leaves one of both ends alone."""
    size = "cast(shiftleft(1, cast(floor(log2({0})) as int)) as int)"
    key = "array(xxhash64('a', slice(words, 1, {0})), xxhash64('b', slice(words, n - {0} + 1, {0})))"
    own, shorter = size.format("n div 2"), size.format("(n - 1) div 2")
    return F.expr(f"CASE WHEN n < {min_words} THEN cast(array() as array<bigint>) WHEN n = {min_words} OR {own} = {shorter} THEN {key.format(own)} ELSE concat({key.format(own)}, {key.format(shorter)}) END")


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (key, place, line): the line itself at place 0, and without each word; the key covers the number of words left.

    ``lines`` is partitioned by ``line``, so the running hashes need no exchange. A word is hashed with its
    place (``a``), and with the place it has once a word before it is gone (``b``); XOR adds them up.
    """
    rows = lines.withColumn("whole", F.expr("aggregate(transform(words, (w, i) -> xxhash64(w, i + 1)), 0L, (x, y) -> x ^ y)"))
    rows = rows.withColumn("shifted", F.expr("aggregate(transform(words, (w, i) -> xxhash64(w, i)), 0L, (x, y) -> x ^ y)"))
    each = rows.select("line", "n", "shifted", F.posexplode("words").alias("i", "word"))
    each = each.withColumn("a", F.expr("xxhash64(word, i + 1)")).withColumn("b", F.expr("xxhash64(word, i)"))
    upto = Window.partitionBy("line").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("sum_a", F.expr("bit_xor(a)").over(upto)).withColumn("sum_b", F.expr("bit_xor(b)").over(upto))
    less = each.select(F.expr("xxhash64(sum_a ^ a ^ shifted ^ sum_b, n - 1)").alias("key"), (F.col("i") + 1).alias("place"), "line")
    return less.union(rows.select(F.expr("xxhash64(whole, n)"), F.lit(0), "line"))


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed occurrence: (id, text_tag, line_no, first_id, first_line_no, edits)."""
    raw = _lines(df, id_col, text_col)
    hashed = [F.xxhash64("words").alias("line"), F.xxhash64(F.lit("check"), F.col("words")).alias("check")]
    lines = raw.select("id", "tag", "no", words_of(F.col("line")).alias("words")).filter(F.size("words") > 0).withColumn("n", F.size("words"))
    occur = written(lines.select("id", "tag", "no", *hashed, _ends(min_words).alias("ends")), "lines")
    distinct = written(occur.groupBy("line", "check").agg(F.min(F.struct("id", "no")).alias("first")), "distinct-lines")

    # lines that share an end with another line
    ends = occur.select("line", F.explode("ends").alias("end"))
    shared = ends.groupBy("end").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low <> high").select("end")
    close = ends.join(shared, "end", "left_semi").select("line").distinct()
    place = written(distinct.join(close, "line").select("line", F.col("first.id").alias("id"), F.col("first.no").alias("no")), "close-lines")

    # their words come from one occurrence, the first; a broadcast only below a checked number of rows
    small = place.count() <= BROADCAST_ROWS
    found = raw.select("id", "no", F.col("line").alias("raw")).join(F.broadcast(place) if small else place, ["id", "no"])
    found = found.withColumn("words", words_of(F.col("raw"))).filter(F.xxhash64("words") == F.col("line"))
    found = found.dropDuplicates(["line"]).select("line", F.size("words").alias("n"), "words", F.struct("id", "no").alias("first"))
    texts = written(found, "close-words")
    variants = written(_variants(texts.select("line", "words", "n").repartition("line")), "variants")

    # only keys that two lines have go on; what is left is about as many rows as there are near repeats
    met = variants.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low <> high").select("key")
    rows = written(variants.join(met, "key", "left_semi").join(texts.select("line", "first"), "line"), "near-variants")

    # replaced words: the same place is missing; inserted words: one line as it is, the other without a word
    one = F.min(F.struct("first", "line")).alias("least")
    gone, whole = rows.filter("place > 0"), rows.filter("place = 0")
    by_place = gone.join(gone.groupBy("key", "place").agg(one), ["key", "place"]).select("line", "least")
    longer = gone.join(whole.groupBy("key").agg(one), "key").select("line", "least")
    shorter = whole.join(gone.groupBy("key").agg(one), "key").select("line", "least")
    near = by_place.union(longer).union(shorter).filter("line <> least.line").groupBy("line").agg(F.min("least").alias("least"))

    # verify the words, then let every line point at its earliest neighbour or itself
    pairs = near.select("line", F.col("least.line").alias("other")).join(texts.select("line", "words", "n"), "line")
    pairs = pairs.join(texts.select(F.col("line").alias("other"), F.col("words").alias("others"), F.col("n").alias("m"), F.col("first").alias("near")), "other")
    good = pairs.filter(_one_edit()).select("line", "near")
    target = distinct.select("line", "check", "first").join(good, "line", "left")
    target = target.withColumn("edits", F.when(F.col("near") < F.col("first"), 1).otherwise(0)).withColumn("earliest", F.least("first", F.coalesce("near", "first")))
    out = occur.select("id", "tag", "no", "line", "check").join(target.select("line", "check", "earliest", "edits"), ["line", "check"])
    out = out.filter(F.col("earliest") < F.struct("id", "no"))
    return out.select(_back("id").alias(id_col), F.col("tag").alias("text_tag"), F.col("no").alias("line_no"), _back("earliest.id").alias(f"first_{id_col}"), F.col("earliest.no").alias("first_line_no"), "edits")


def _one_edit() -> Column:
    """Whether ``words`` (n) and ``others`` (m) differ by one word at most.

    With p the first place where they differ, what follows it must agree.
    """
    p = "coalesce(array_position(transform(sequence(1, least(n, m)), i -> words[i - 1] = others[i - 1]), false), 0)"
    after = "CASE WHEN p = 0 THEN abs(n - m) <= 1 WHEN n = m THEN slice(words, p + 1, n) = slice(others, p + 1, m) WHEN n = m + 1 THEN slice(words, p + 1, n) = slice(others, p, m) WHEN m = n + 1 THEN slice(words, p, n) = slice(others, p + 1, m) ELSE false END"
    return F.expr(f"element_at(transform(array(cast({p} as int)), p -> {after}), 1)")


def _back(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with the removed lines cut from ``text_col``; rows that had lines and lose them all are left out.

    All other columns stay as they are.
    """
    gone = repeated_lines(df, id_col, text_col, min_words)
    gone = gone.groupBy(F.coalesce(id_col, F.lit(NO_ID)).alias("id"), F.col("text_tag").alias("tag")).agg(F.collect_set("line_no").alias("gone"))
    # the columns travel as one, whatever their names
    text = F.col(text_col).cast("string")
    rows = df.select(F.struct(*df.columns).alias("row"), text.alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tag"))
    kept = F.expr("filter(split(text, '\\n'), (l, i) -> NOT array_contains(gone, i + 1))")
    joined = rows.join(gone, ["id", "tag"], "left").withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
    joined = joined.filter(F.col("gone").isNull() | F.exists("kept", lambda line: F.size(words_of(line)) > 0))
    new_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n"))
    return joined.select(*[new_text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS no, unnest(ls) AS line FROM d),
w AS (SELECT doc_id, no, list_filter(regexp_split_to_array(line, '[ \\t\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM l),
o AS (SELECT doc_id, no, ws, array_to_string(ws, ' ') AS s, len(ws) AS n FROM w WHERE len(ws) > 0),
u AS (SELECT s, any_value(ws) AS ws, any_value(n) AS n, min({{'d': doc_id, 'no': no}}) AS f FROM o GROUP BY s),
v AS (SELECT s, f, n, p, array_to_string(list_concat(ws[:p - 1], ws[p + 1:]), ' ') AS k
      FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM u WHERE n >= {MIN_WORDS})),
r AS (SELECT s, min(f) OVER (PARTITION BY k, p, n) AS f2 FROM v),
i1 AS (SELECT v.s, u.f AS f2 FROM v JOIN u ON u.s = v.k AND u.n = v.n - 1 WHERE u.n >= {MIN_WORDS}),
i2 AS (SELECT u.s, v.f AS f2 FROM v JOIN u ON u.s = v.k AND u.n = v.n - 1 WHERE u.n >= {MIN_WORDS}),
near AS (SELECT s, min(f2) AS f2 FROM (SELECT * FROM r UNION ALL SELECT * FROM i1 UNION ALL SELECT * FROM i2) GROUP BY s),
t AS (SELECT u.s, CASE WHEN near.f2 < u.f THEN near.f2 ELSE u.f END AS e, CASE WHEN near.f2 < u.f THEN 1 ELSE 0 END AS edits
      FROM u LEFT JOIN near ON u.s = near.s)
SELECT o.doc_id, CAST(o.no AS INTEGER) AS line_no, t.e.d AS first_doc_id, CAST(t.e.no AS INTEGER) AS first_line_no, t.edits AS edits
FROM o JOIN t ON o.s = t.s
WHERE t.e < {{'d': o.doc_id, 'no': o.no}}"""
