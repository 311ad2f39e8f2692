"""Sequence preparation for next-item models.

Sequences are kept in long form -- one row per (user, pos, item) -- built
with the range-partitioned ordinal, so no step needs all rows of one user in
one task. Arrays are only built for windows bounded by ``max_len`` (the part a
sequence model reads), after the window filter has cut the rows down.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.functions.exprs import left_pad, multi_hot
from reelrank.functions.hashing import hash52, uniform01
from reelrank.operators.ordinal import with_ordinal
from reelrank.session import ensure_checkpoint_dir, shuffle_partitions

# Fixed values of the sequence model configuration.
MAX_LEN = 80
MASK_PROB = 0.15
NUM_NEGATIVES = 100
MIN_TRAIN_POSITIVES = 4
MIN_TEST_POSITIVES = 13
HOLDOUT = 10
# Explode long integer ranges in chunks so one row never fans out into one huge task.
RANGE_CHUNK = 4096
# Draws that a task makes and dedupes (about 60 MB).
DRAWS_A_TASK = 500_000


def min_activity(r: DataFrame, n: int, user: str = "userId") -> DataFrame:
    """Keep rows of users with at least ``n`` rows (count per user is a
    partial aggregation; the filter is a left-semi join)."""
    active = r.groupBy(user).count().filter(F.col("count") >= n).select(user)
    return r.join(active, user, "left_semi")


def id_map(df: DataFrame, col: str) -> DataFrame:
    """Dense 0-based index over the distinct ids, ascending.

    (The reference numbers ids by first appearance in a pandas frame, which a
    distributed table does not define; ascending id is the stable choice.)
    """
    ids = df.select(F.col(col).alias("id")).distinct().withColumn("_one", F.lit(0))
    out = with_ordinal(ids, "_one", ["id"], pos_col="_pos", size_col="_n", materialize=True)
    return out.select("id", (F.col("_pos") - 1).alias("idx"))


def vocab_sizes(items: DataFrame, users: DataFrame, item: str = "movieId",
                user: str = "userId") -> DataFrame:
    """Number of distinct items and users, in one aggregation over the
    tagged union of both id columns."""
    tagged = (items.select(F.col(item).cast("bigint").alias("_id"), F.lit(0).alias("_kind"))
                   .unionByName(users.select(F.col(user).cast("bigint").alias("_id"),
                                             F.lit(1).alias("_kind"))))
    return tagged.agg(
        F.count_distinct(F.when(F.col("_kind") == 0, F.col("_id"))).alias("num_item"),
        F.count_distinct(F.when(F.col("_kind") == 1, F.col("_id"))).alias("num_user"))


def user_sequences(r: DataFrame, user: str = "userId", item: str = "movieId",
                   ts: str = "ts") -> DataFrame:
    """Long-form time-ordered sequence: (user, pos, item, n).
    Materialised: sequences feed several branches (windows, holdouts,
    transitions, sampling)."""
    return (with_ordinal(r.select(user, item, ts), user, [ts, item], materialize=True)
            .select(user, "pos", item, "n"))


def leave_one_out(seqs: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """The last item is the validation target; the rest is training input.
    Returns (user, n_train, valid_item)."""
    last = seqs.filter(F.col("pos") == F.col("n"))
    return last.select(user, (F.col("n") - 1).alias("n_train"), F.col(item).alias("valid_item"))


def last_n_holdout(seqs: DataFrame, n: int = HOLDOUT, min_len: int = MIN_TEST_POSITIVES) -> DataFrame:
    """For users with at least ``min_len`` items, the last ``n`` are
    truth and the rest input. Adds ``part`` = 'input' | 'truth'."""
    kept = seqs.filter(F.col("n") >= min_len)
    return kept.withColumn("part", F.when(F.col("pos") > F.col("n") - n, "truth").otherwise("input"))


def window_arrays(seqs: DataFrame, max_len: int, user: str = "userId", item: str = "movieId",
                  upto: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Collect the last ``max_len`` positions (optionally only pos <= upto
    column) into ordered arrays per user. Only <= max_len rows per user reach
    the aggregation."""
    last = F.col(upto) if upto else F.col("n")
    win = seqs.filter((F.col("pos") <= last) & (F.col("pos") > last - max_len))
    fields = [item, *extra]
    agg = (win.groupBy(user)
              .agg(F.array_sort(F.collect_list(F.struct("pos", *fields))).alias("_w")))
    return agg.select(user, *[F.transform("_w", _field_getter(f)).alias(f + "s") for f in fields])


def _field_getter(name: str):
    # one-argument lambda: a two-argument one would be read as (element, index)
    return lambda s: s[name]


def pad_sequences(seqs: DataFrame, max_len: int = MAX_LEN, user: str = "userId",
                  item: str = "movieId", exclude_last: bool = True) -> DataFrame:
    """training input = all but the last item, keep last ``max_len``,
    left-pad with 0. Returns (user, seq)."""
    s = seqs.withColumn("_upto", F.col("n") - 1 if exclude_last else F.col("n"))
    arr = window_arrays(s, max_len, user, item, upto="_upto")
    return arr.select(user, left_pad(f"{item}s", max_len).alias("seq"))


def genre_table(items: DataFrame, vocabulary: Sequence[str], item: str = "movieId",
                genres: str = "genres", substring: bool = False) -> DataFrame:
    """Per item multi-hot genre vector over ``vocabulary``."""
    return items.select(item, multi_hot(genres, vocabulary, substring).alias("genre_vec"))


def genre_vocabulary(items: DataFrame, genres: str = "genres") -> list[str]:
    """Distinct genre tokens, ascending: the columns of the multi-hot vector
    (the vector's width, which its consumers hold in each row anyway)."""
    toks = items.select(F.explode(F.split(genres, r"\|")).alias("g")).distinct().orderBy("g")
    return [r.g for r in toks.toLocalIterator()]


def genre_sequences(seqs: DataFrame, genre_vecs: DataFrame, n_genres: int,
                    max_len: int = MAX_LEN, user: str = "userId", item: str = "movieId",
                    exclude_last: bool = True) -> DataFrame:
    """Genre rows aligned with the padded item sequence (zero rows for pads)."""
    s = (seqs.join(genre_vecs, item, "left")
             .withColumn("genre_vec", F.coalesce("genre_vec", F.array_repeat(F.lit(0), n_genres)))
             .withColumn("_upto", F.col("n") - 1 if exclude_last else F.col("n")))
    arr = window_arrays(s, max_len, user, item, upto="_upto", extra=["genre_vec"])
    zero = F.array_repeat(F.lit(0), n_genres)
    return arr.select(user, left_pad("genre_vecs", max_len, pad=zero).alias("genre_seq"))


# ---------------------------------------------------------------- sampling

def explode_range(df: DataFrame, length: str, out: str = "t", chunk: int = RANGE_CHUNK,
                  tasks: int | None = None) -> DataFrame:
    """One row per t in [0, length) for each input row. Long ranges are first
    split into chunks (rows spread by the following shuffle), then each chunk
    is exploded, so a huge length does not become one huge task. The shuffle
    has ``tasks`` partitions, by default the session's number: left to their
    size, the short rows before the explosion would be merged into one."""
    tasks = tasks or shuffle_partitions(df.sparkSession)
    chunks = (df.withColumn("_c", F.explode(F.sequence(F.lit(0), F.greatest(
                  F.ceil(F.col(length) / chunk).cast("int") - 1, F.lit(0)))))
                .repartition(tasks, "_c", *[c for c in df.columns if c != length][:1]))
    lo = F.col("_c") * chunk
    hi = F.least(lo + chunk, F.col(length)) - 1
    return (chunks.filter(lo < F.col(length))
                  .withColumn(out, F.explode(F.sequence(lo, hi))).drop("_c"))


def draw_tasks(draws: float, least: int) -> int:
    """Partitions for that many draws: ``DRAWS_A_TASK`` in each."""
    return max(least, math.ceil(draws / DRAWS_A_TASK))


def sample_unrated(need: DataFrame, rated: DataFrame, items: DataFrame, seed: int = 0,
                   user: str = "userId", item: str = "movieId", n_col: str = "n_needed") -> DataFrame:
    """For each user of ``need`` draw ``n_needed`` distinct items the
    user has not rated, uniformly and independently of other users (all
    unrated items when there are fewer).

    A user who needs n items and has rated r of the catalogue's I draws item
    numbers by hash of (seed, user, draw) and keeps the first n distinct
    unrated ones of 4 n + 64 draws. Most users have them after 1.3 n + 16, and
    only the others draw on. With 2 (n + r) < I more than half of all
    draws are new, so these suffice but for a negligible chance; users left
    short, and users with 2 (n + r) >= I, order the whole catalogue by hash of
    (seed, user, item) instead, which for the latter is at most 2 (n + r) rows.
    Both are uniform draws without replacement, and neither enumerates users
    x items. Draws are told apart, and freed of what was rated, by item number,
    in as many partitions as their count asks for; the numbers become items
    when they are chosen. Returns (user, item, draw) with draw = 0, 1, ... in
    drawing order.
    """
    index = id_map(items, item).select(F.col("id").alias(item), "idx")
    n_items = index.count()                                       # one scalar
    rated_d = rated.select(user, item).distinct().join(index, item).select(user, "idx")
    rcount = rated_d.groupBy(user).agg(F.count(F.lit(1)).alias("_r"))
    plan = (need.select(user, F.col(n_col).cast("int").alias("_n")).join(rcount, user, "left")
                .withColumn("_dense", 2 * (F.col("_n") + F.coalesce("_r", F.lit(0))) >= n_items))
    # three scalars; partial top-k: each task forwards at most the largest request of rows a user
    asked = need.agg(F.max(n_col).alias("most"), F.sum(n_col).alias("all"), F.count(F.lit(1)).alias("users")).first()
    most = max(int(asked["most"] or 0), 1)
    tasks = draw_tasks(1.3 * (asked["all"] or 0) + 17 * asked["users"], shuffle_partitions(need.sparkSession))

    def drawn(asked: DataFrame, length) -> DataFrame:
        """Distinct unrated item numbers of that many draws, with the first draw of each."""
        rows = explode_range(asked.filter(~F.col("_dense")).select(user, "_n", length.cast("int").alias("_len")), "_len", tasks=tasks)
        return (rows.withColumn("idx", F.pmod(hash52(seed, "draw", user, "t"), F.lit(max(n_items, 1))).cast("int"))
                    .repartition(tasks, user, "idx")
                    .groupBy(user, "_n", "idx").agg(F.min("t").cast("bigint").alias("_o"))
                    .join(rated_d, [user, "idx"], "left_anti")
                    .select(user, "_n", "idx", "_o"))

    def first(found: DataFrame) -> DataFrame:
        from reelrank.operators.rank import top_k
        return (top_k(found.withColumn("_neg", -F.col("_o")), most, user, "_neg", "idx", "_k")
                .filter(F.col("_k") <= F.col("_n")).select(user, "_n", "idx", (F.col("_k") - 1).alias("draw")))

    def named(chosen: DataFrame) -> DataFrame:
        return chosen.repartition(tasks, "idx").join(index, "idx").select(user, "_n", item, "draw")

    ensure_checkpoint_dir(need.sparkSession)
    # no user has more than 1.3 n + 17 rows here, so they meet by user before they are ranked
    early = named(first(drawn(plan, F.ceil(1.3 * F.col("_n")) + 16).repartition(tasks, user))).checkpoint(eager=True)
    done = early.groupBy(user).agg(F.count(F.lit(1)).alias("_got"), F.max("_n").alias("_n")).filter("_got = _n").select(user)
    rest = plan.filter("_n > 0").join(done, user, "left_anti")
    if rest.isEmpty():
        return early.select(user, item, "draw")
    more = drawn(rest, 4 * F.col("_n") + 64)
    found = more.groupBy(user).agg(F.count(F.lit(1)).alias("_found"))
    whole = (rest.join(found, user, "left")
                 .filter(F.col("_dense") | (F.coalesce("_found", F.lit(0)) < F.col("_n")))
                 .select(user, "_n", F.lit(n_items).alias("_len")))
    ordered = (explode_range(whole, "_len").withColumnRenamed("t", "idx").join(index, "idx")
               .join(rated_d, [user, "idx"], "left_anti")
               .withColumn("_o", F.lit(1 << 52).cast("bigint") + hash52(seed, "item", user, item)))
    cand = (more.unionByName(ordered.select(user, "_n", "idx", "_o"))
                .groupBy(user, "_n", "idx").agg(F.min("_o").alias("_o")))
    late = first(cand).join(index, "idx").select(user, "_n", item, "draw")
    return early.join(done, user, "left_semi").unionByName(late).select(user, item, "draw")


def sample_negatives(users: DataFrame, rated: DataFrame, items: DataFrame, n: int = NUM_NEGATIVES,
                     seed: int = 0, user: str = "userId", item: str = "movieId") -> DataFrame:
    """``n`` unrated items per user (fewer when not enough exist)."""
    need = users.select(user).distinct().withColumn("n_needed", F.lit(n))
    return sample_unrated(need, rated, items, seed, user, item)


def masked_sequences(seqs: DataFrame, items: DataFrame, genre_vecs: DataFrame | None,
                     n_genres: int, max_len: int = MAX_LEN, mask_prob: float = MASK_PROB,
                     seed: int = 0, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Masked-item training examples over the training window.

    For each of the last ``max_len`` training positions: with probability
    ``mask_prob`` the position is chosen; a chosen position becomes the mask
    token (80%), a random item the user has not rated (10%) or stays (10%).
    Labels keep the original items and ``is_masked`` marks chosen positions.
    Token ids: items are the 1-based catalogue index, 0 = pad, I + 1 = mask.
    Draws come from a hash of (seed, user, pos), so retries and different
    partitionings reproduce them.
    """
    imap = id_map(items, item).select(F.col("id").alias(item), (F.col("idx") + 1).alias("tok"))
    n_item = imap.count()                                         # one scalar
    train = seqs.filter((F.col("pos") < F.col("n")) & (F.col("pos") >= F.col("n") - max_len))
    u = uniform01(seed, "mask", user, "pos")
    v = u / mask_prob
    marked = (train.join(imap, item, "left")
                   .withColumn("chosen", (u < mask_prob).cast("int"))
                   .withColumn("action", F.when(u >= mask_prob, "keep")
                                          .when(v < 0.8, "mask")
                                          .when(v < 0.9, "random").otherwise("keep")))
    need = (marked.filter(F.col("action") == "random").groupBy(user)
                  .agg(F.count(F.lit(1)).alias("n_needed")))
    draws = sample_unrated(need, seqs.select(user, item), items, seed + 7, user, item)
    draws = draws.join(imap.withColumnRenamed(item, "_rnd_item").withColumnRenamed("tok", "_rnd_tok"),
                       draws[item] == F.col("_rnd_item")).select(user, "draw", "_rnd_item", "_rnd_tok")
    # random slots per user are a subset of the <= max_len window rows
    rnd_slots = (marked.filter(F.col("action") == "random").select(user, "pos")
                       .withColumn("draw", F.row_number().over(
                           Window.partitionBy(user).orderBy("pos")) - 1))
    marked = marked.join(rnd_slots.join(draws, [user, "draw"]).select(user, "pos", "_rnd_item", "_rnd_tok"),
                         [user, "pos"], "left")
    token = (F.when(F.col("action") == "mask", F.lit(n_item + 1))
              .when(F.col("action") == "random", F.col("_rnd_tok"))
              .otherwise(F.col("tok")))
    marked = marked.withColumn("token", token).withColumn("label_tok", F.col("tok"))
    extra = ["token", "label_tok", "chosen"]
    if genre_vecs is not None:
        ones = F.array_repeat(F.lit(1), n_genres)  # the mask token's genre row: all ones
        zero = F.array_repeat(F.lit(0), n_genres)
        gv = genre_vecs.select(F.col(item).alias("_g_item"), "genre_vec")
        marked = (marked.join(gv, F.col("_g_item") == F.when(F.col("action") == "random",
                                                              F.col("_rnd_item")).otherwise(F.col(item)),
                              "left")
                        .withColumn("genre_row", F.when(F.col("action") == "mask", ones)
                                                  .otherwise(F.coalesce("genre_vec", zero))))
        extra.append("genre_row")
    marked = marked.withColumn("_upto", F.col("n") - 1)
    arr = window_arrays(marked, max_len, user, "token", upto="_upto", extra=extra[1:])
    cols = [user,
            left_pad("tokens", max_len).alias("tokens"),
            left_pad("label_toks", max_len).alias("labels"),
            left_pad("chosens", max_len).alias("is_masked")]
    if genre_vecs is not None:
        cols.append(left_pad("genre_rows", max_len, pad=F.array_repeat(F.lit(0), n_genres)).alias("genre_seq"))
    return arr.select(*cols)


# ---------------------------------------------------------------- serving

def serving_sequences(requests: DataFrame, items: DataFrame, max_len: int = MAX_LEN,
                      req: str = "request_id", item: str = "movieId",
                      genre_vecs: DataFrame | None = None, n_genres: int = 0) -> DataFrame:
    """Long-form requests (request, pos, item) -> encoded known items in
    order, mask token appended, last ``max_len`` kept, left-padded; with
    ``genre_vecs`` also the tokens' genre rows (zeros for pads, the mask token
    and items without one).

    Unknown items are dropped before the window, so the window holds the
    last ``max_len - 1`` known items plus the mask token."""
    imap = id_map(items, item).select(F.col("id").alias(item), (F.col("idx") + 1).alias("tok"))
    n_item = imap.count()                                         # one scalar
    known = requests.join(imap, item)  # inner join drops unknown ids
    zero = F.array_repeat(F.lit(0), n_genres)
    extra = []
    if genre_vecs is not None:
        known = known.join(genre_vecs, item, "left").withColumn("genre_vec", F.coalesce("genre_vec", zero))
        extra = ["genre_vec"]
    ordered = with_ordinal(known.select(req, "pos", "tok", *extra).withColumnRenamed("pos", "_orig"),
                           req, ["_orig"])
    arr = window_arrays(ordered, max_len - 1, req, "tok", extra=extra)
    all_reqs = requests.select(req).distinct().join(arr, req, "left")
    toks = F.array_append(F.coalesce("toks", F.array().cast("array<int>")), F.lit(n_item + 1).cast("int"))
    cols = [req, left_pad(toks, max_len).alias("tokens")]
    if genre_vecs is not None:
        rows = F.array_append(F.coalesce("genre_vecs", F.array().cast("array<array<int>>")), zero)
        cols.append(left_pad(rows, max_len, pad=zero).alias("genre_seq"))
    return all_reqs.select(*cols)


def transitions(seqs: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Item-to-item transition counts from consecutive sequence positions.
    The pairing is an equi-join on (user, pos), not a per-user window."""
    a = seqs.select(user, "pos", F.col(item).alias("prev_item"))
    b = seqs.select(user, (F.col("pos") - 1).alias("pos"), F.col(item).alias("next_item"))
    return (a.join(b, [user, "pos"]).groupBy("prev_item", "next_item")
             .agg(F.count(F.lit(1)).alias("transitions")))


def next_scores(requests: DataFrame, trans: DataFrame, req: str = "request_id",
                item: str = "movieId") -> DataFrame:
    """M25 (re-aimed): score of every item that follows one of the request's
    items: the sum of the transition counts from its distinct items. Items of
    the request are left out. Returns (request, item, score)."""
    given = requests.select(req, item).distinct()
    return (given.select(req, F.col(item).alias("prev_item")).join(trans, "prev_item")
                .groupBy(req, F.col("next_item").alias(item)).agg(F.sum("transitions").alias("score"))
                .join(given, [req, item], "left_anti"))


def next_items(requests: DataFrame, trans: DataFrame, popularity: DataFrame, k: int = 10,
               req: str = "request_id", item: str = "movieId") -> DataFrame:
    """M25 (re-aimed): the k best next items of each request by
    :func:`next_scores`, backed off to ``popularity`` (item, count; each
    catalogue item once): ties and items that follow none of the request's
    items are ordered by count, then id, so every request gets k rows as far
    as the catalogue allows. Returns (request, rank, item, score).

    Of the items without a score only the k most popular ones that the request
    neither holds nor has scored can be taken; they are among the first
    k + (its held and scored items) of one list, and a request reads no more of
    it than that."""
    scored = next_scores(requests, trans, req, item)
    pop = popularity.select(item, F.col("count").alias("_c"))
    best = _ranked(scored.join(pop, item, "left").withColumn("_c", F.coalesce("_c", F.lit(0))), k, req, item)
    full = best.groupBy(req).agg(F.max("rank").alias("_have"))
    short = (requests.select(req).distinct().join(full, req, "left")
             .filter(F.coalesce("_have", F.lit(0)) < k).select(req))
    # a short request has fewer than k scored items, so its prefix is k + held + k at most
    order = with_ordinal(pop.withColumn("_one", F.lit(0)), "_one", [F.col("_c").desc(), F.col(item).asc()],
                         pos_col="_p", size_col="_i", materialize=True)
    held = (requests.select(req, item).distinct().join(short, req, "left_semi")
            .groupBy(req).agg((F.count(F.lit(1)) + 2 * k).cast("int").alias("_len")))
    reads = explode_range(held, "_len").withColumn("_p", (F.col("t") + 1).cast("int"))
    fill = (reads.join(order.select("_p", item, "_c"), "_p")
            .join(requests.select(req, item).distinct(), [req, item], "left_anti")
            .join(best.select(req, item), [req, item], "left_anti")
            .select(req, item, F.lit(0).cast("bigint").alias("score"), "_c"))
    both = best.select(req, item, "score", "_c").unionByName(fill)
    return _ranked(both, k, req, item).select(req, "rank", item, "score")


def _ranked(df: DataFrame, k: int, req: str, item: str) -> DataFrame:
    w = Window.partitionBy(req).orderBy(F.desc("score"), F.desc("_c"), F.col(item))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
