"""Line deduplication by a deletion-neighbourhood join.

Two lines are alike when one word replaced, added or left out makes them
equal. Every line is filed under the hash of each variant that lacks one word,
with the place of that word, and under its own hash: lines that differ in one
word meet under the same variant and place, lines of which one has a word more
meet where the variant of one is the other. What meets is verified by its
words. A line is dropped when an earlier line (by id, then line number) is
equal or alike.

Equal lines are merged before anything is filed. Of the rest only lines that
share their leading or trailing half with another one can be alike at all (a
single edit leaves one half whole), so only these are filed.

Lines of few words can be compared by their characters in the same way (one
character replaced, added or left out), if a least number of them is given.

Only DataFrame functions are used. A variant or line that very many lines
share costs one row each: members of a group meet its earliest line, never
each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import written

WHITE = "[\\x20\\x09-\\x0D]+"


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``doc`` (hash of the text), ``line_no`` (from 0), ``words`` of
    every line."""
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("doc"),
                        F.posexplode(split).alias("line_no", "line"))
            .select("id", "doc", "line_no", _words(F.col("line")).alias("words")))


def _words(line: Column) -> Column:
    bare = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    return F.when(bare != "", F.split(bare, WHITE)).otherwise(F.array().cast("array<string>"))


def _key(words: Column) -> Column:
    return F.unhex(F.md5(F.array_join(words, " ").cast("binary")))


def _tokens(words: Column, min_words: int, min_chars: int | None) -> Column:
    """What an edit replaces, adds or leaves out: the words of a line, or the
    characters of one with few words; null where only equality counts. A
    space before each character tells it from a word."""
    if min_chars is None:
        return F.when(F.size(words) >= min_words, words)
    line = F.array_join(words, " ")
    chars = F.transform(F.split(line, ""), lambda c: F.concat(F.lit(" "), c))
    return F.when(F.size(words) >= min_words, words).when(F.char_length(line) >= max(min_chars, 1), chars)


def _halves(tokens: Column) -> Column:
    """Hashes of the leading and trailing halves that an alike line of the same
    length, one token more or one token less would share."""
    n = F.size(tokens)
    long, short = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")

    def both(h: Column) -> list[Column]:
        return [F.xxhash64(F.lit("lead"), h, F.slice(tokens, 1, h)),
                F.xxhash64(F.lit("trail"), h, F.slice(tokens, n - h + 1, h))]

    return F.when(n % 2 == 0, F.array(*both(long), *both(short))).otherwise(F.array(*both(long)))


def _alike(a: Column, b: Column) -> Column:
    """Whether at most one word must be replaced, added or left out."""
    def same(x: Column, y: Column) -> Column:  # equal leading words; one side may be longer
        at = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(at == 0, F.greatest(F.size(x), F.size(y)).cast("long")).otherwise(at - 1)

    most = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (same(a, b) + same(F.reverse(a), F.reverse(b)) >= most - 1)


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8,
              min_chars: int | None = None) -> DataFrame:
    """One row per line: ``id``, ``line_no``, ``n_words``, ``kept``, and the
    earliest equal or alike line ``keep_id``, ``keep_line`` (a kept line's own).

    Lines are the parts between line feeds, words what white space separates;
    white space itself does not count. A line without words is always kept.
    Lines of fewer than ``min_words`` words are compared by characters with
    each other if they have at least ``min_chars`` of them (one space between
    words), else for equality only; None compares all of them for equality
    only. A null text has one line
    without words. A null id comes before all others; rows that repeat an id
    are told apart by their lines, and of wholly equal rows one is kept. An
    empty table gives an empty result.
    """
    every = lines(docs, id_col, text_col).withColumn("tokens", _tokens(F.col("words"), min_words, min_chars))
    n = F.size("words")
    # row tells apart lines of equal id, number and words, so that one of them stays
    table = written(every.select("id", "doc", "line_no", F.monotonically_increasing_id().alias("row"), n.alias("n"),
                                 F.when(n > 0, _key(F.col("words"))).alias("key"), F.when(F.col("tokens").isNotNull(), _halves(F.col("tokens"))).alias("halves")),
                    "lines")
    distinct = (table.filter("key IS NOT NULL").groupBy("key")
                .agg(F.min(F.struct("id", "line_no", "row", "doc")).alias("first"), F.first("halves").alias("halves")))
    filed = distinct.filter("halves IS NOT NULL").select("key", F.explode("halves").alias("half"))
    shared = filed.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    able = filed.join(shared, "half").select("key").distinct()
    firsts = distinct.select("key", "first.*")
    able = written(able.join(firsts, "key"), "lines-able")

    # the words or characters of able lines, from the text that their first occurrence is in
    whole = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("d"), F.col(text_col).alias("t"))
    text = (able.join(whole, F.col("id").eqNullSafe(F.col("i")) & (F.col("doc") == F.col("d")))
            .select("key", F.struct("id", "line_no", "key").alias("at"), F.split("t", "\n")[F.col("line_no")].alias("line"))
            .groupBy("key", "at").agg(F.first("line").alias("line")))
    text = written(text.select("at", _tokens(_words(F.col("line")), min_words, min_chars).alias("words")), "lines-text")
    near = _nearest(text)
    verdict = (firsts.join(near, "key", "left")
               .select("key", F.coalesce("near", F.struct("id", "line_no")).alias("keep"),
                       F.col("near").isNull().alias("stays"), F.struct("id", "line_no", "row").alias("first")))
    joined = table.drop("halves").join(verdict, "key", "left")
    at = F.struct("id", "line_no", "row")
    kept = F.col("key").isNull() | (F.col("stays") & (at == F.col("first")))
    return joined.select("id", "line_no", F.col("n").alias("n_words"), kept.alias("kept"),
                         F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
                         F.when(F.col("key").isNull(), F.col("line_no")).otherwise(F.col("keep.line_no")).alias("keep_line"))


def _nearest(text: DataFrame) -> DataFrame:
    """``key``, ``near``: the earliest verified alike line that comes before the
    line, for lines that have one."""
    hashes = text.select("at", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))

    def lacking(i: Column) -> Column:  # a hash over two lists is that over both in turn
        return F.xxhash64(F.slice("h", 1, i), F.slice("h", i + 2, F.size("h")))

    places = F.transform(F.sequence(F.lit(0), F.size("h") - 1),
                         lambda i: F.struct(i.alias("place"), lacking(i).alias("variant")))
    # several joins below need the variants: they are made once
    variants = written(hashes.select("at", F.explode(places).alias("v")).select("at", "v.place", "v.variant"), "lines-variants")
    whole = hashes.select(F.col("at").alias("whole"), F.xxhash64("h").alias("variant"))
    replaced = variants.groupBy("variant", "place").agg(F.min("at").alias("near"), F.max("at").alias("last")).filter("near <> last")
    one = variants.join(replaced.drop("last"), ["variant", "place"]).filter("near < at").select("at", "near")
    more = variants.join(whole, "variant").select(F.greatest("at", "whole").alias("at"), F.least("at", "whole").alias("near"))
    # several earlier lines may meet a line: each is verified, the earliest that holds is taken
    pairs = one.union(more).filter("near < at").distinct()
    own = text.select("at", "words")
    checked = (pairs.join(own, "at").join(own.select(F.col("at").alias("near"), F.col("words").alias("other")), "near")
               .filter(_alike(F.col("words"), F.col("other"))))
    return (checked.groupBy("at").agg(F.min("near").alias("near"))
            .select(F.col("at.key").alias("key"), F.struct("near.id", "near.line_no").alias("near")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8,
                min_chars: int | None = None) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts; ids must be
    unique, as lines are told by id and number. Rows with a null id or text
    are left as they are."""
    gone = (decisions(docs, id_col, text_col, min_words, min_chars).filter("NOT kept AND id IS NOT NULL")
            .groupBy(F.col("id").alias("_gone_id")).agg(F.collect_set("line_no").alias("_gone")))
    parts = F.split(F.col(f"_row.{text_col}"), "\n")
    left = F.filter(parts, lambda line, i: ~F.array_contains("_gone", i))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    out = docs.select(row).join(gone, F.col(f"_row.{id_col}") == F.col("_gone_id"), "left")
    text = F.when(F.col("_gone").isNull(), F.col(f"_row.{text_col}")).otherwise(F.array_join(left, "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
