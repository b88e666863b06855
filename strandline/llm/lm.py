"""LM scoring (10): a log-bilinear model, trained in numpy by noise-contrastive estimation.

The model predicts a token from the two tokens before it: their vectors, each weighted per dimension, add up to the
predicted vector. Tokens form groups: the end is one, the TOP most frequent words are in groups of GROUP by frequency,
other words share SHARED groups by their last two bytes. The products of the predicted vector with the groups' vectors,
normalised over all groups, give the group; those with the vectors of a group's words, normalised over the group, give
the word; both are batched matrix products. A shared group splits by add-one counts. So the probabilities of all tokens
sum to one.

Both levels are trained by noise-contrastive estimation, the noise being the groups' frequencies and the words' within
their group. Training begins on a bounded sample and goes on over every training text, in ROUNDS: each takes a part of the
texts, dealt by hash into shards of about SHARD_TOKENS tokens, trains each shard from the same start, and averages the
results by their tokens. What a shard holds, and in which order, doesn't depend on how the table is partitioned.

Counts cover all training texts. Words are told apart by 64-bit hashes. The TABLE most frequent words' counts go to the
tasks (8 MB at most); rarer words of each text are joined with the whole vocabulary.

Null texts are empty: their only token is the end. Without training texts every score is the base score. A null doc_id
has no remainder: its text is no training text and not held out. Repeated documents get a row each; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import HashIndex, Words, give_back, hot_count, materialize, small_batches, table, text_chunks

TABLE, TOP, GROUP, SHARED, DIM, NOISE, BATCH = 1 << 19, 4096, 64, 64, 16, 8, 16_384
SAMPLE_TEXTS, SAMPLE_CHARS = 1000, 4000
ROUNDS, SHARD_TOKENS, CHUNK_CHARS = 3, 3_000_000, 1 << 20
#: Words that a task counts before it passes counts on.
COUNTED = 3_000_000
NAMES = ("context", "weights", "group", "group_bias", "word", "word_bias")


def _split(doc_id, fold: int):
    return F.crc32(doc_id.cast("string")) % fold


class Classes:
    """Context classes of tokens: 0 the end, 1 to n_own the frequent words, then the shared ones; groups: 0 the end, then
    those of frequent words, then the shared ones."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, ends: int, shared: np.ndarray):
        order = np.argsort(-counts, kind="stable")[:TOP]
        self.n_own = len(order)
        self.of_word = np.zeros(len(words) + 1, np.int32)  # 0: by its last bytes
        self.of_word[order] = np.arange(1, self.n_own + 1)
        self.n_groups = -(-self.n_own // GROUP)
        own = counts[order].astype(float)
        per = np.add.reduceat(own, np.arange(0, self.n_own, GROUP)) if self.n_own else own
        groups = np.concatenate(([ends], per, shared)) + 1.0
        self.unigram = groups / groups.sum()
        within = own + 1.0
        self.within = within / np.repeat(np.add.reduceat(within, np.arange(0, self.n_own, GROUP)), np.minimum(GROUP, self.n_own - np.arange(0, self.n_own, GROUP)))[: self.n_own] if self.n_own else within

    def of(self, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        own = self.of_word[at]
        return np.where(own > 0, own, self.n_own + 1 + last % SHARED)

    def group(self, token: np.ndarray) -> np.ndarray:
        return np.where(token == 0, 0, np.where(token <= self.n_own, 1 + (token - 1) // GROUP, self.n_groups + token - self.n_own))


def contexts(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, one before, two before) for texts' words with an end put after each text; before a text stand ends."""
    t = np.insert(classes, first[1:], 0)
    one, two = np.concatenate(([0], t[:-1])), np.concatenate(([0, 0], t[:-2]))[: len(t)]
    two[first[:-1] + np.arange(len(first) - 1)] = 0
    return t, one, two


def initial(c: Classes) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    vectors = lambda n: rng.normal(0, 0.1, (n, DIM)).astype(np.float32)
    n = c.n_own + 1 + SHARED
    return {"context": vectors(n), "weights": np.ones((2, DIM), np.float32), "group": vectors(len(c.unigram)), "group_bias": np.log(c.unigram).astype(np.float32), "word": vectors(c.n_own), "word_bias": np.log(c.within).astype(np.float32)}


def _by_group(group: np.ndarray, n_groups: int):
    """(group - 1, rows) of the frequent words' groups."""
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(1, n_groups + 2))
    for g in range(n_groups):
        if cuts[g] < cuts[g + 1]:
            yield g, order[cuts[g] : cuts[g + 1]]


class Trainer:
    """Noise-contrastive estimation with per-parameter step sizes."""

    def __init__(self, model: dict[str, np.ndarray], classes: Classes, rate: float, batch: int = BATCH):
        self.m = {k: v.copy() for k, v in model.items()}
        self.seen = {k: np.full_like(v, 1e-2) for k, v in self.m.items()}
        self.c, self.rate, self.batch, self.rng, self.tokens = classes, rate, batch, np.random.default_rng(11), 0
        self.noise = np.cumsum(classes.unigram)
        self.shift = np.log(NOISE * classes.unigram).astype(np.float32)
        self.word_shift = np.log(NOISE * classes.within).astype(np.float32)
        self.word_noise = [np.cumsum(classes.within[g * GROUP : (g + 1) * GROUP]) for g in range(classes.n_groups)]

    def _move(self, name: str, grad: np.ndarray) -> None:
        self.seen[name] += grad * grad
        self.m[name] += self.rate * grad / np.sqrt(self.seen[name])

    def learn(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, group = self.m, self.c.group(token)
        for b in range(0, len(token), self.batch):
            w, g, h1, h2 = (v[b : b + self.batch] for v in (token, group, one, two))
            size = np.float32(1 / len(w))
            v1, v2 = m["context"][h1], m["context"][h2]
            guess = v1 * m["weights"][0] + v2 * m["weights"][1]
            grad = {k: np.zeros_like(v) for k, v in m.items()}
            scatter = lambda at, x, n: np.stack([np.bincount(at, x[:, d], n) for d in range(DIM)], 1).astype(np.float32)

            q = m["group"][g]
            fake = np.minimum(np.searchsorted(self.noise, self.rng.random(NOISE)), len(self.shift) - 1)
            up = 1 / (1 + np.exp((guess * q).sum(1) + m["group_bias"][g] - self.shift[g]))
            down = -1 / (1 + np.exp(-(guess @ m["group"][fake].T + m["group_bias"][fake] - self.shift[fake])))
            pull = up[:, None] * q + down @ m["group"][fake]
            grad["group"] += scatter(g, up[:, None] * guess, len(self.shift))
            np.add.at(grad["group"], fake, down.T @ guess)
            grad["group_bias"] += np.bincount(g, up, len(self.shift)).astype(np.float32)
            np.add.at(grad["group_bias"], fake, down.sum(0))

            up_all = np.zeros(len(w), np.float32)
            for k, rows in _by_group(g, self.c.n_groups):
                at, x = w[rows] - 1, guess[rows]
                fake = k * GROUP + np.minimum(np.searchsorted(self.word_noise[k], self.rng.random(NOISE)), len(self.word_noise[k]) - 1)
                q = m["word"][at]
                up = 1 / (1 + np.exp((x * q).sum(1) + m["word_bias"][at] - self.word_shift[at]))
                down = -1 / (1 + np.exp(-(x @ m["word"][fake].T + m["word_bias"][fake] - self.word_shift[fake])))
                pull[rows] += up[:, None] * q + down @ m["word"][fake]
                np.add.at(grad["word"], fake, down.T @ x)
                np.add.at(grad["word_bias"], fake, down.sum(0))
                up_all[rows] = up
            own = np.flatnonzero((w > 0) & (w <= self.c.n_own))
            if len(own):
                grad["word"] += scatter(w[own] - 1, up_all[own, None] * guess[own], self.c.n_own)
                grad["word_bias"] += np.bincount(w[own] - 1, up_all[own], self.c.n_own).astype(np.float32)
            grad["context"] += scatter(np.concatenate((h1, h2)), np.concatenate((pull * m["weights"][0], pull * m["weights"][1])), len(m["context"]))
            grad["weights"] += np.stack(((pull * v1).sum(0), (pull * v2).sum(0)))
            for name, x in grad.items():
                self._move(name, x * size)
            self.tokens += len(w)


def log_probabilities(m: dict[str, np.ndarray], c: Classes, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Natural log probabilities of tokens, of a shared group as a whole for its words."""
    out = np.empty(len(token), np.float64)

    def normalised(s: np.ndarray, at: np.ndarray) -> np.ndarray:
        s -= s.max(1, keepdims=True)
        picked = s[np.arange(len(s)), at].copy()
        return picked - np.log(np.exp(s, out=s).sum(1))

    for b in range(0, len(token), 32_768):
        w, h1, h2 = (v[b : b + 32_768] for v in (token, one, two))
        g = c.group(w)
        guess = m["context"][h1] * m["weights"][0] + m["context"][h2] * m["weights"][1]
        p = normalised(guess @ m["group"].T + m["group_bias"], g)
        for k, rows in _by_group(g, c.n_groups):
            words = slice(k * GROUP, (k + 1) * GROUP)
            p[rows] += normalised(guess[rows] @ m["word"][words].T + m["word_bias"][words], w[rows] - 1 - k * GROUP)
        out[b : b + 32_768] = p
    return out


def _row(tokens: int, model: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), *(pa.array([model[k].astype(np.float32).tobytes()]) for k in NAMES)], ["tokens", *NAMES])


_MODEL = "tokens long, " + ", ".join(f"{k} binary" for k in NAMES)


def _averaged(shapes):
    def run(batches):
        total, tokens = None, 0
        for batch in batches:
            for r in batch.to_pylist():
                model = {k: np.frombuffer(r[k], np.float32).reshape(shapes[k]) * np.float64(r["tokens"]) for k in NAMES}
                total = {k: total[k] + model[k] for k in NAMES} if total else model
                tokens += r["tokens"]
        if tokens:
            yield _row(tokens, {k: v / tokens for k, v in total.items()})

    return run


def lm_scores(docs: DataFrame, fold: int = 7, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per document."""
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    train = docs.where(_split(F.col("doc_id"), fold) != held_out)

    def count(batches):
        held: list[Words] = []
        n_texts = 0

        def flush():
            h, first, n = np.unique(np.concatenate([w.hash for w in held]), return_index=True, return_counts=True)
            last = np.concatenate([w.last for w in held])[first]
            return pa.RecordBatch.from_arrays([pa.array(np.append(h.view(np.int64), 0)), pa.array(np.append(last % SHARED, -1)), pa.array(np.append(n, n_texts))], ["w", "shared", "n"])

        for ids, texts in text_chunks(batches):
            held.append(Words(texts))
            n_texts += len(ids)
            if sum(len(w.hash) for w in held) >= COUNTED:
                yield flush()
                held, n_texts = [], 0
        if held:
            yield flush()

    # the row with shared -1 counts the ends
    vocabulary = materialize(train.mapInArrow(count, "w long, shared long, n long").groupBy("w", (F.col("shared") < 0).alias("end")).agg(F.min("shared").alias("shared"), F.sum("n").alias("n")))
    total = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("end"), F.col("n"))).alias("ends")).first()
    n_train, distinct, ends = total["n"] or 0, total["v"], total["ends"] or 0
    words = vocabulary.where("not end")
    head = words.orderBy(F.desc("n"), "w").limit(TABLE).toArrow()
    order = np.argsort(head["w"].to_numpy().view(np.uint64))
    known, counts = head["w"].to_numpy()[order].view(np.uint64), head["n"].to_numpy()[order]
    shared_of = head["shared"].to_numpy()[order]
    mass = np.zeros(SHARED)
    freq = np.zeros(SHARED)
    for r in words.groupBy("shared").agg(F.sum(F.col("n") + 1).alias("m"), F.sum("n").alias("n")).collect():  # SHARED rows at most
        mass[r["shared"]], freq[r["shared"]] = r["m"], r["n"]
    own = np.argsort(-counts, kind="stable")[:TOP]  # these have groups of their own
    np.subtract.at(mass, shared_of[own], counts[own] + 1)
    np.subtract.at(freq, shared_of[own], counts[own])
    classes = Classes(known, counts, ends, freq)
    split = np.log10(mass + 1)
    tables = spark.sparkContext.broadcast((known, counts, classes))

    def sequence(texts, known, classes, index):
        w = Words(texts)
        at = index.find(w.hash)
        return w, at, contexts(classes.of(at, w.last), w.first)

    model = initial(classes)
    if n_train:
        keyed = train.withColumn("h", F.xxhash64("doc_id", "text"))
        share = min(1.0, 4 * SAMPLE_TEXTS / ends)
        some = keyed.where(F.length("text").between(1, SAMPLE_CHARS)).where(F.pmod(F.shiftright("h", 20), F.lit(1 << 20)) < share * (1 << 20))
        sample = [r["text"] for r in some.orderBy("h", "doc_id").limit(SAMPLE_TEXTS).select("text").toLocalIterator()]
        start, index = Trainer(model, classes, 0.1, 512), HashIndex(known)
        for _ in range(3 if sample else 0):
            start.learn(*sequence(sample, known, classes, index)[2])
        model = start.m
        shapes = {k: v.shape for k, v in model.items()}
        shards = max(1, -(-n_train // (ROUNDS * SHARD_TOKENS)))
        # rows that are repeated very often are dealt one by one, so that they aren't one shard's
        hot = materialize(keyed.groupBy("h").agg(F.count("*").alias("count")).where(F.col("count") > hot_count(ends)).select("h", F.lit(True).alias("hot")))
        row = F.when(F.col("hot"), F.xxhash64("h", F.monotonically_increasing_id())).otherwise(F.col("h"))
        spread = keyed.join(F.broadcast(hot), "h", "left").withColumn("h", row)
        for number in range(ROUNDS):
            begun = spark.sparkContext.broadcast(model)

            def train_on(batches):
                known, _, classes = tables.value
                index, trainer, shard, texts, held = HashIndex(known), None, None, [], 0
                for batch in batches:
                    for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                        if s != shard or held >= CHUNK_CHARS:
                            if texts:
                                trainer.learn(*sequence(texts, known, classes, index)[2])
                            if s != shard:
                                if trainer:
                                    yield _row(trainer.tokens, trainer.m)
                                shard, trainer = s, Trainer(begun.value, classes, 0.05)
                            texts, held = [], 0
                        texts.append(t or "")
                        held += len(texts[-1])
                if texts:
                    trainer.learn(*sequence(texts, known, classes, index)[2])
                    yield _row(trainer.tokens, trainer.m)
                give_back()

            part = spread.where(F.pmod("h", F.lit(ROUNDS)) == number).withColumn("shard", F.pmod(F.shiftright("h", 8), F.lit(shards)))
            dealt = part.repartition("shard").sortWithinPartitions("shard", "h", "doc_id").select("shard", "text")
            merged = dealt.mapInArrow(train_on, _MODEL).repartition(16).mapInArrow(_averaged(shapes), _MODEL).toArrow()
            got = next(_averaged(shapes)(merged.to_batches()), None)
            if got is not None:
                final = got.to_pylist()[0]
                model = {k: np.frombuffer(final[k], np.float32).reshape(shapes[k]) for k in NAMES}

    scoring = spark.sparkContext.broadcast(model)
    denominator = np.log10(n_train + distinct + 1)

    def score(batches):
        known, counts, classes = tables.value
        index = HashIndex(known)
        key, row = TaskContext.get().partitionId() << 33, 0
        end_base = np.log10(ends + 1)
        for ids, texts in text_chunks(batches):
            w, at, tokens = sequence(texts, known, classes, index)
            begin = w.first[:-1] + np.arange(len(ids))
            length = np.diff(w.first)
            logp = log_probabilities(scoring.value, classes, *tokens) / np.log(10)
            c = np.where(at >= 0, counts[at] if len(counts) else 0, 0)
            base = np.log10(c + 1.0)
            rest = np.where(classes.of_word[at] > 0, 0.0, base - split[w.last % SHARED])
            sums = lambda x: np.add.reduceat(np.append(x, 0.0), np.minimum(w.first[:-1], len(x))) * (length > 0)
            base_sum = sums(base) + end_base - (length + 1) * denominator
            model_sum = np.add.reduceat(logp, begin) + sums(rest)
            found = sums((at >= 0).astype(float)).astype(np.int64) + (ends > 0)
            tail = np.flatnonzero(at < 0)
            offsets = np.searchsorted(tail, w.first).astype(np.int32)
            tails = pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.hash[tail].view(np.int64)))
            keys = key + row + np.arange(len(ids))
            row += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids, pa.int64()), pa.array(length + 1), pa.array(found), pa.array(base_sum), pa.array(model_sum), tails], ["key", "doc_id", "n_tokens", "n_known", "base_score", "score", "tail"])

    scored = materialize(docs.mapInArrow(score, "key long, doc_id long, n_tokens long, n_known long, base_score double, score double, tail array<long>"))
    rare = scored.select("key", F.explode("tail").alias("w")).join(words.select("w", "n"), "w")
    more = rare.groupBy("key").agg(F.count("*").alias("k"), F.sum(F.log10(F.col("n") + 1)).alias("s"))
    joined = scored.join(more, "key", "left")
    base = F.col("base_score") + F.coalesce("s", F.lit(0.0))
    return joined.select("doc_id", (F.coalesce(_split(F.col("doc_id"), fold) == held_out, F.lit(False))).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("s", F.lit(0.0)) if n_train else base).alias("score"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
