"""Named queries for the sequence-model preparation and evaluation steps."""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators import metrics as M
from reelrank.operators import prep as P
from reelrank.operators import sequences as S
from reelrank.operators.features import index_ids, token_vocabulary
from reelrank.plans.frames import Frames
from reelrank.plans.registry import K, csv_ints, query

SEED = 42


def train_positives(f: Frames) -> DataFrame:
    """Positives of train + validation with their timestamps (the sequence
    model's training table)."""
    cols = ["userId", "movieId", "rating", "ts"]
    return P.positives(f.history().select(*cols))


def active_train(f: Frames) -> DataFrame:
    return S.min_activity(train_positives(f), S.MIN_TRAIN_POSITIVES)


def train_sequences(f: Frames) -> DataFrame:
    """Time-ordered sequences of the active training users, written once."""
    return f.shared("train-sequences", lambda: S.user_sequences(active_train(f)))


def train_transitions(f: Frames) -> DataFrame:
    return f.shared("train-transitions", lambda: S.transitions(train_sequences(f)))


def active_test(f: Frames) -> DataFrame:
    """Evaluation users: at least 13 positives over the whole ratings table
    (a tenth of a history is too short for a 10-item holdout)."""
    cols = ["userId", "movieId", "rating", "ts"]
    return S.min_activity(P.positives(f.ratings.select(*cols)), S.MIN_TEST_POSITIVES)


def genre_rows(col: str):
    """A list of genre vectors as text: values by commas, vectors by semicolons."""
    return F.array_join(F.transform(col, lambda r: F.array_join(r, ",")), ";")


def item_tokens(f: Frames) -> DataFrame:
    """movieId -> token (1-based catalogue index)."""
    return S.id_map(f.movies, "movieId").select(F.col("id").alias("movieId"),
                                                (F.col("idx") + 1).alias("tok"))


@query("min_activity_4")
def min_activity_4(spark, sf_dir):
    """train+validation positives of users with >= 4 of them."""
    return active_train(Frames(spark, sf_dir)).select("userId", "movieId", "rating")


@query("min_activity_13")
def min_activity_13(spark, sf_dir):
    """Positives of users with >= 13 of them (holdout population)."""
    return active_test(Frames(spark, sf_dir)).select("userId", "movieId", "rating")


@query("vocab_sizes")
def vocab_sizes(spark, sf_dir):
    """Catalogue size and number of active users."""
    f = Frames(spark, sf_dir)
    return S.vocab_sizes(f.movies, active_train(f))


@query("id_map")
def id_map(spark, sf_dir):
    """Item map over the catalogue and user map over active users."""
    f = Frames(spark, sf_dir)
    items = S.id_map(f.movies, "movieId").withColumn("kind", F.lit("item"))
    users = S.id_map(active_train(f), "userId").withColumn("kind", F.lit("user"))
    return items.unionByName(users).select("kind", "id", "idx")


@query("encode_ids")
def encode_ids(spark, sf_dir):
    """Test positives encoded with maps built on the training side
    (unknown item -> 0, unknown user -> -1)."""
    f = Frames(spark, sf_dir)
    imap = S.id_map(f.movies, "movieId")
    umap = S.id_map(active_train(f), "userId")
    enc = P.encode_ids(P.positives(f.test).select("userId", "movieId"), imap, umap)
    return enc.select("userId", "movieId", "item_idx", "user_idx")


@query("user_sequences")
def user_sequences(spark, sf_dir):
    """Time-ordered positive sequences in long form."""
    f = Frames(spark, sf_dir)
    return train_sequences(f).select("userId", "pos", "movieId")


@query("leave_one_out")
def leave_one_out(spark, sf_dir):
    """Last positive per user is the validation item."""
    f = Frames(spark, sf_dir)
    return S.leave_one_out(train_sequences(f))


def _holdout(f: Frames) -> DataFrame:
    seqs = f.shared("holdout-sequences", lambda: S.user_sequences(active_test(f)))
    return S.last_n_holdout(seqs, S.HOLDOUT, S.MIN_TEST_POSITIVES)


@query("last_n_holdout")
def last_n_holdout(spark, sf_dir):
    """Last 10 positives are truth, the rest input (users >= 13)."""
    h = _holdout(Frames(spark, sf_dir))
    truth = S.window_arrays(h.filter(F.col("part") == "truth"), S.HOLDOUT)
    n_input = h.groupBy("userId").agg(F.sum((F.col("part") == "input").cast("int")).alias("n_input"))
    return n_input.join(truth, "userId").select("userId", "n_input",
                                                 csv_ints("movieIds").alias("truth"))


def _token_seqs(f: Frames) -> DataFrame:
    return train_sequences(f).join(item_tokens(f), "movieId")


@query("pad_sequences")
def pad_sequences(spark, sf_dir):
    """last 80 training tokens per user (all but the last), left-padded."""
    f = Frames(spark, sf_dir)
    out = S.pad_sequences(_token_seqs(f), S.MAX_LEN, item="tok")
    return out.select("userId", csv_ints("seq").alias("seq"))


@query("genre_multi_hot")
def genre_multi_hot(spark, sf_dir):
    """Exact multi-hot over the genre vocabulary (tokens ascending)."""
    f = Frames(spark, sf_dir)
    vocab = S.genre_vocabulary(f.movies)
    out = S.genre_table(f.movies, vocab)
    return out.select("movieId", csv_ints("genre_vec").alias("genre_vec"))


@query("genre_sequences")
def genre_sequences(spark, sf_dir):
    """Genre rows aligned with the padded training sequence."""
    f = Frames(spark, sf_dir)
    vocab = S.genre_vocabulary(f.movies)
    gv = S.genre_table(f.movies, vocab)
    out = S.genre_sequences(train_sequences(f), gv, len(vocab), S.MAX_LEN)
    return out.select("userId", genre_rows("genre_seq").alias("genre_seq"))


@query("genre_skew")
def genre_skew(spark, sf_dir):
    """items flagged per genre by exact token match vs. substring match."""
    f = Frames(spark, sf_dir)
    vocab = S.genre_vocabulary(f.movies)
    ex = S.genre_table(f.movies, vocab).select("movieId", F.col("genre_vec").alias("e"))
    sb = S.genre_table(f.movies, vocab, substring=True).select("movieId", F.col("genre_vec").alias("s"))
    both = ex.join(sb, "movieId")
    exploded = both.select(F.posexplode("e").alias("gi", "ev"), "s").select(
        "gi", "ev", F.col("s")[F.col("gi")].alias("sv"))
    names = F.element_at(F.array(*[F.lit(v) for v in vocab]), F.col("gi") + 1)
    return (exploded.groupBy("gi").agg(F.sum("ev").cast("bigint").alias("exact_items"),
                                       F.sum("sv").cast("bigint").alias("substring_items"))
                    .select(names.alias("genre"), "exact_items", "substring_items"))


@query("genre_vocab")
def genre_vocab(spark, sf_dir):
    """M7: lower-cased pipe tokens of the training rows, counted and indexed
    by count desc, token asc (the CountVectorizer vocabulary order)."""
    f = Frames(spark, sf_dir)
    tok = RegexTokenizer(inputCol="genres", outputCol="genres_tokens", pattern="\\|")
    return token_vocabulary(tok.transform(f.temp("train")), "genres_tokens")


@query("index_ids")
def index_ids_q(spark, sf_dir):
    """M6: user index fitted on train (frequency desc, then id text asc),
    applied to test users; unseen users get the label count."""
    f = Frames(spark, sf_dir)
    return index_ids(f.train, f.test.select("userId").distinct(), "userId", "userIndex")


@query("negatives")
def negatives(spark, sf_dir):
    """100 unrated items per holdout user (rated = input + truth)."""
    f = Frames(spark, sf_dir)
    h = _holdout(f)
    return S.sample_negatives(h.select("userId"), h.select("userId", "movieId"), f.movies,
                              S.NUM_NEGATIVES, SEED)


@query("sampled_metrics")
def sampled_metrics(spark, sf_dir):
    """Truth (last 10) + 100 sampled negatives per user, ranked by the
    deterministic item score; nDCG / HIT / precision / recall @10."""
    f = Frames(spark, sf_dir)
    h = _holdout(f)
    negs = S.sample_negatives(h.select("userId"), h.select("userId", "movieId"), f.movies,
                              S.NUM_NEGATIVES, SEED)
    truth = h.filter(F.col("part") == "truth").select("userId", "movieId", F.lit(True).alias("is_truth"))
    cand = truth.unionByName(negs.select("userId", "movieId", F.lit(False).alias("is_truth")))
    cand = (cand.join(f.item_score, "movieId", "left")
                .withColumn("score", F.coalesce("score", F.lit(0.0))))
    return M.sampled_metrics(cand, K)


@query("masked_sequences")
def masked_sequences(spark, sf_dir):
    """Masked training examples (15% chosen; 80/10/10), labels, flags,
    genre rows; max_len 80."""
    f = Frames(spark, sf_dir)
    vocab = S.genre_vocabulary(f.movies)
    gv = S.genre_table(f.movies, vocab)
    out = S.masked_sequences(train_sequences(f), f.movies, gv, len(vocab),
                             S.MAX_LEN, S.MASK_PROB, SEED)
    return out.select("userId", csv_ints("tokens").alias("tokens"),
                      csv_ints("labels").alias("labels"), csv_ints("is_masked").alias("is_masked"),
                      genre_rows("genre_seq").alias("genre_seq"))


def _requests(f: Frames) -> DataFrame:
    """Test-split positive histories in time order as serving requests."""
    seqs = f.shared("request-sequences", lambda: S.user_sequences(P.positives(f.test)))
    return seqs.select(F.col("userId").alias("request_id"), "pos", "movieId")


def popularity(f: Frames) -> DataFrame:
    """Every catalogue item with its number of training positives."""
    counts = active_train(f).groupBy("movieId").agg(F.count(F.lit(1)).alias("count"))
    return (f.movies.select("movieId").distinct().join(counts, "movieId", "left")
             .select("movieId", F.coalesce("count", F.lit(0)).alias("count")))


def next_recs(f: Frames) -> DataFrame:
    trans = train_transitions(f)
    return S.next_items(_requests(f), trans, popularity(f), K)


@query("serving_sequences")
def serving_sequences(spark, sf_dir):
    """Encode known items, append the mask token, last 80, pad;
    genre rows of the tokens."""
    f = Frames(spark, sf_dir)
    vocab = S.genre_vocabulary(f.movies)
    out = S.serving_sequences(_requests(f), f.movies, S.MAX_LEN,
                              genre_vecs=S.genre_table(f.movies, vocab), n_genres=len(vocab))
    return out.select("request_id", csv_ints("tokens").alias("tokens"), genre_rows("genre_seq").alias("genre_seq"))


@query("transitions")
def transitions(spark, sf_dir):
    """Item-to-item transition counts of the training sequences."""
    f = Frames(spark, sf_dir)
    return train_transitions(f)


@query("next_items")
def next_items(spark, sf_dir):
    """M25 (re-aimed): top-10 next items by the transition counts from all of
    the request's items, then popularity; items of the request excluded."""
    return next_recs(Frames(spark, sf_dir))



@query("next_item_sampled_metrics")
def next_item_sampled_metrics(spark, sf_dir):
    """M16 applied to the re-aimed next-item model (M25): holdout users'
    truth (last 10) + 100 sampled negatives, scored by the transition count
    from the user's last input item (0 when none), with transitions learnt
    from all positive sequences minus the truth rows; nDCG / HIT / precision
    / recall @10."""
    f = Frames(spark, sf_dir)
    h = _holdout(f)
    negs = S.sample_negatives(h.select("userId"), h.select("userId", "movieId"), f.movies,
                              S.NUM_NEGATIVES, SEED)
    truth = h.filter(F.col("part") == "truth").select("userId", "movieId", F.lit(True).alias("is_truth"))
    cand = truth.unionByName(negs.select("userId", "movieId", F.lit(False).alias("is_truth")))
    last_input = (h.filter(F.col("part") == "input").groupBy("userId")
                   .agg(F.max_by("movieId", "pos").alias("prev_item")))
    # transitions learnt from every positive sequence with the holdout truth
    # rows removed, so no truth item is seen in training
    cols = ["userId", "movieId", "rating", "ts"]
    learn = P.positives(f.ratings.select(*cols)).join(truth.select("userId", "movieId"),
                                                      ["userId", "movieId"], "left_anti")
    trans = S.transitions(S.user_sequences(learn))
    scored = (cand.join(last_input, "userId", "left")
                  .join(trans.withColumnRenamed("next_item", "movieId"), ["prev_item", "movieId"], "left")
                  .withColumn("score", F.coalesce(F.col("transitions").cast("double"), F.lit(0.0))))
    return M.sampled_metrics(scored, K)
