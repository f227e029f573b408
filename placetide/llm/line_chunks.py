"""Removal of repeated passages by content-defined chunks of lines.

The hash of a line alone decides whether it is a boundary; a chunk runs from one boundary line to
the next, both included. So a chunk depends on nothing outside it: equal passages are cut alike
wherever they stand, an inserted line changes only the chunks over it, and every chunk has two
lines or more. Neighbouring chunks share their boundary line. All but one in ``SPARING`` lines of
some length are boundaries, for many shared passages have two or three lines only: sparser ones
would miss those. Short lines are none, so that a pair of closing brackets is not a chunk.

Chunks whose hash occurs more than once are compared byte by byte; of equal ones the first stays
(by document id, then place) and the lines of the others are removed. Chunks are judged on the
input, not on what is left.

Texts are cut row by row with built-in expressions. Hashes alone are counted over the corpus;
only texts that hold a chunk with a repeated hash move, once, and only places come back. Texts that
lose nothing do not move to be cut.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placetide.llm.shared import filter_computed, free_name, stored
from placetide.llm.shared import marked as _marked

# One line in so many is no boundary, nor is a line of fewer characters.
SPARING = 32
MIN_LINE = 8
# A hash of more than one chunk in so many is hot: there are fewer such hashes than this.
HOT = 1000


def line_hash(line: Column) -> Column:
    """31 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("bigint") % F.lit(1 << 31)


def chunked(df: DataFrame, text: str = "text", sparing: int = SPARING) -> DataFrame:
    """Adds the arrays ``lines`` and ``starts`` (boundary lines, from 0) under free names; NULL
    text gives NULL arrays.

    Chunk k holds the lines from ``starts[k]`` to ``starts[k + 1]``, both included. The first and
    the last line are always boundaries; a text of one line has no chunk.
    """
    lines, starts = (free_name(df.columns, n) for n in ("lines", "starts"))
    d = df.withColumn(lines, F.split(F.col(text), "\n"))
    last = F.size(lines) - 1
    line = lambda i: F.get(F.col(lines), i)
    asks = lambda i: (F.length(line(i)) >= MIN_LINE) & (line_hash(line(i)) % sparing != 0)
    cuts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (i == last) | asks(i))
    return d.withColumn(starts, F.when(F.col(lines).isNotNull(), cuts))


def _chunks(rows: DataFrame, sparing: int, body: bool) -> DataFrame:
    """``key, version, place, hash`` of every chunk of ``key, version, text``, with ``body`` if
    asked for. Further columns stay."""
    others = [c for c in rows.columns if c != "text"]
    d = chunked(rows.filter(F.instr("text", "\n") > 0), "text", sparing)
    # Chunks are made inside the row: a row that is exploded should not carry its whole text.
    held = lambda s, p: F.slice("lines", s + 1, F.get("starts", p + 1) - s + 1)
    if body:
        one = lambda s, p: F.struct(F.xxhash64(held(s, p)).alias("hash"), F.array_join(held(s, p), "\n").alias("body"))
    else:
        one = lambda s, p: F.struct(F.xxhash64(held(s, p)).alias("hash"))
    made = F.transform(F.slice("starts", F.lit(1), F.size("starts") - 1), one)
    # Every such text has a chunk. The outer form only keeps a test for that, which would
    # compute all of this once more, from being put below it.
    d = d.select(*others, made.alias("made")).select(*others, F.posexplode_outer("made").alias("place", "one"))
    return d.select(*others, "place", "one.*")


def repeated_chunks(df: DataFrame, key: str = "doc_id", text: str = "text", sparing: int = SPARING) -> DataFrame:
    """``key, version, place`` of every chunk that equals an earlier one; ``version`` is the XXH64
    of the text, so that rows sharing a key are told apart.

    Earlier means a smaller key, then version, then place; a NULL key comes last. Rows that
    repeat both key and text count as one text.
    """
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    hashes = stored(_chunks(rows, sparing, body=False), "hashes")
    repeated = stored(hashes.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    hot = repeated.filter(F.col("n") > F.lit(hashes.count() / HOT)).select("hash")
    held = _bodies(rows, _on_hash(hashes, repeated.select("hash"), hot, "left_semi"), sparing)
    order = F.struct(F.col("key").isNull().alias("late"), *[F.col(c).alias(c) for c in ("key", "version", "place")])
    # Equal bytes make a group. Nearly always all chunks of a hash do: then the hash names it and
    # texts need not move again to bring the group's first chunk to the others.
    groups = held.groupBy("hash", "body").agg(F.min(order).alias("first"))
    firsts = stored(groups.groupBy("hash").agg(F.count("*").alias("bodies"), F.min("first").alias("first")), "firsts")
    columns = ["key", "version", "place", "first"]
    same = _on_hash(hashes, firsts.filter("bodies = 1"), hot, "inner").select(*columns)
    clashing = firsts.filter("bodies > 1").select("hash")
    if not clashing.isEmpty():
        held = stored(_bodies(rows, hashes.join(clashing, "hash", "left_semi"), sparing), "clashing")
        groups = held.groupBy("hash", "body").agg(F.min(order).alias("first"))
        same = same.unionByName(held.join(groups, ["hash", "body"]).select(*columns))
    is_first = reduce(and_, [F.col(c).eqNullSafe(F.col(f"first.{c}")) for c in ("key", "version", "place")])
    return same.filter(~is_first).select("key", "version", "place").distinct()


def _on_hash(chunks: DataFrame, other: DataFrame, hot: DataFrame, how: str) -> DataFrame:
    """``chunks`` joined on ``hash`` with a table of one row a hash.

    The chunks of the hashes in ``hot`` stay where they are, as the other side has fewer than
    ``HOT`` rows of them, which are sent to all tasks; a hash of the rest is too rare to fill a task.
    """
    hot = F.broadcast(hot)
    few = F.broadcast(other.join(hot, "hash", "left_semi"))
    here = chunks.join(hot, "hash", "left_semi").join(few, "hash", how)
    rest = chunks.join(hot, "hash", "left_anti").join(other.join(hot, "hash", "left_anti"), "hash", how)
    return here.unionByName(rest)


def _bodies(rows: DataFrame, places: DataFrame, sparing: int) -> DataFrame:
    """``key, version, place, hash, body`` of the chunks at ``places``."""
    wanted = places.groupBy("key", "version").agg(F.collect_set("place").alias("places"))
    wanted = stored(wanted.withColumnsRenamed({"key": "k", "version": "v"}), "wanted")
    rows, mark = _marked(rows, [F.col("key"), F.col("version")], wanted.select("k", "v"))
    both = F.col("key").eqNullSafe(F.col("k")) & (F.col("version") == F.col("v"))
    moved = rows.filter(mark).drop(mark).join(wanted.hint("merge"), both).drop("k", "v")
    found = _chunks(moved, sparing, body=True)
    return filter_computed(found, F.array_contains("places", F.col("place"))).drop("places")


def _without(df: DataFrame, key: str, text: str, sparing: int) -> tuple[DataFrame, str, str]:
    """Every row with ``text`` cut, and the names of two added columns: its lines before and what
    is left of them, NULL where nothing was removed."""
    removed = repeated_chunks(df, key, text, sparing).filter("key IS NOT NULL")
    found = removed.groupBy("key", "version").agg(F.array_sort(F.collect_set("place")).alias("gone"))
    link, version, gone = (free_name(df.columns, n) for n in ("_key", "_version", "_gone"))
    found = stored(found.toDF(link, version, gone), "found")
    rows, mark = _marked(df, [F.col(key), F.xxhash64(text)], found.select(link, version))
    same = (F.col(key) == F.col(link)) & (F.xxhash64(text) == F.col(version))
    touched = rows.filter(mark).drop(mark).join(found.hint("merge"), same, "left").drop(link, version)
    whole = rows.filter(~F.col(mark)).drop(mark).withColumn(gone, F.lit(None).cast(found.schema[gone].dataType))
    cut = chunked(touched.unionByName(whole), text, sparing)
    lines, starts = cut.columns[-2:]

    def kept(j: Column) -> Column:
        """The lines between the removed chunks j - 1 and j."""
        before, after = F.get(F.col(gone), j - 1), F.get(F.col(gone), j)
        begin = F.when(j == 0, 0).otherwise(F.get(F.col(starts), before + 1) + 1)
        end = F.when(j == F.size(gone), F.size(lines)).otherwise(F.get(F.col(starts), after))
        return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

    left = free_name(cut.columns, "_left")
    spans = F.transform(F.sequence(F.lit(0), F.size(gone)), kept)
    cut = cut.withColumn(left, F.when(F.col(gone).isNotNull(), F.flatten(spans)))
    return cut.withColumn(text, F.when(F.col(left).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))), lines, left


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", sparing: int = SPARING
) -> DataFrame:
    """Every row with repeated chunks cut from ``text``, and ``n_lines`` and ``n_removed`` (lines)
    added under free names.

    A text that loses all its lines becomes empty; NULL text stays NULL with 0 lines. Rows with
    a NULL key lose nothing. Extra columns stay.
    """
    cut, lines, left = _without(df, key, text, sparing)
    total = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines))
    lost = F.when(F.col(left).isNull(), 0).otherwise(F.size(lines) - F.size(left))
    return cut.select(
        *df.columns,
        total.cast("bigint").alias(free_name(df.columns, "n_lines")),
        lost.cast("bigint").alias(free_name(df.columns, "n_removed")),
    )


def keep_new_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without repeated chunks; those that consisted of nothing else are gone."""
    cut, _, left = _without(docs, key, text, SPARING)
    return filter_computed(cut, F.col(left).isNull() | (F.size(left) > 0)).select(*docs.columns)


# The same chunks in SQL: the first of equal chunks stays.
SQL = f"""
WITH lines AS (
  SELECT doc_id, i, line, n,
         i = 0 OR i = n - 1 OR (length(line) >= {MIN_LINE}
           AND ('0x' || substr(md5(line), 1, 8))::BIGINT % {1 << 31} % {SPARING} <> 0) AS cut
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i,
               len(string_split(text, chr(10))) AS n
        FROM documents WHERE doc_id IS NOT NULL)
), spans AS (
  SELECT doc_id, i AS s, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM lines WHERE cut
), chunks AS (
  SELECT doc_id, s, e, string_agg(line, chr(10) ORDER BY i) AS body
  FROM spans JOIN lines USING (doc_id) WHERE i BETWEEN s AND e GROUP BY doc_id, s, e
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) > 1 AS gone FROM chunks
), kept AS (
  SELECT doc_id, i, line, n,
         EXISTS (SELECT 1 FROM judged j WHERE j.gone AND j.doc_id = l.doc_id AND l.i BETWEEN j.s AND j.e) AS lost
  FROM lines l
)
SELECT d.doc_id, coalesce(k.text, CASE WHEN d.text IS NULL THEN NULL ELSE '' END) AS text,
       coalesce(k.n, 0)::BIGINT AS n_lines, coalesce(k.lost, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost) AS text, max(n) AS n,
         sum(CASE WHEN lost THEN 1 ELSE 0 END) AS lost
  FROM kept GROUP BY doc_id) k USING (doc_id)
"""
