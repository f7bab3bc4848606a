"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary labelled documents, are compared
word by word. A word after another backs off to the word alone, that to its first six characters, that
to its first four, and that to a distribution which both classes share: the counts of the whole
corpus, toxic or not, which also divide a stem among its words. A rare expression thus costs both
classes nearly the same unless its stem tells them apart. Pairs are counted as often as they stand
there; below, a word (or a stem) counts the different words before it. Of each count its order's
discount n1 / (n1 + 2 n2) is taken.

A document's score compares log-likelihoods per word: of the whole text by the models of pairs, and of
its ``TOP`` most toxic words by the models of words alone, so that a long text doesn't thin them out (a
pair after a rare word proves little). A logistic curve of these ratios, fitted on labelled documents
that are held back from the counts and weighted by how frequent their class is among the labels, gives
the probability.

Words are runs of letters and digits, ASCII case folded. Labelled doc_ids are taken in the order of a
hash, at most ``SAMPLE`` of each class and in all ``SAMPLE_WORDS`` words of whole texts of each (a text
that would go beyond is passed over); a doc_id with several labels counts as toxic if one says so, and
one with several texts is learnt from by the least of them. The shared counts, of different words
before a word, are of all words of all rows and stay a distributed table, of which the model takes what
the fitted documents hold. Null and empty texts have no evidence. Repeated rows are scored each; doc_id
may be null; an empty table gives an empty table. Without labels of both classes every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .tables import Scratch, frugal, let_go, ship, trim
from .units import gather
from .words import mixed, prefixes, slices, words

SAMPLE, SAMPLE_WORDS, TOP = 3000, 500_000, 3
#: Words of a class's sample that are one in so many are dealt out by the word before them as well.
HOT_SHARE, SALTS = 1000, 64
#: Different pairs of words that a task gathers before it sends them on.
PAIRS = 1_500_000
#: Buckets of words for each shuffle partition.
BUCKETS = 32
#: Characters of the two stems, and bits of their hashes.
STEMS, STEM_BITS = (6, 4), 40


def _lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def discount(counts: np.ndarray) -> float:
    """Of Kneser and Ney: n1 / (n1 + 2 n2), from how many counts are one and two."""
    n1, n2 = int((counts == 1).sum()), int((counts == 2).sum())
    return min(max(n1 / (n1 + 2 * n2), 0.05), 0.95) if n1 + n2 else 0.5


class Words:
    """The words of one text or more, as arrays: hashes of the word and of its two stems. ``begin`` has
    the first word of each text, and the number of all words at its end."""

    def __init__(self, *of: np.ndarray):
        gap = np.array([32], dtype=np.uint8)
        b = np.concatenate([x for t in of for x in (t, gap)]) if len(of) > 1 else of[0]
        starts, ends, whole = words(b, plain=True)
        self.levels = [whole, *(x >> np.uint64(64 - STEM_BITS) for x in prefixes(b, starts, ends, STEMS))]
        edge = np.cumsum([0, *(len(t) + 1 for t in of)])
        self.begin = np.searchsorted(starts, edge)

    def __len__(self) -> int:
        return len(self.levels[0])

    def packed(self) -> np.ndarray:
        return np.concatenate(self.levels)

    @classmethod
    def unpacked(cls, x: np.ndarray) -> Words:
        out = cls.__new__(cls)
        out.levels = [*x.reshape(3, -1)]
        out.begin = np.array([0, len(out)])
        return out

    def firsts(self) -> np.ndarray:
        """Which words are the first of their text."""
        first = np.zeros(len(self) + 1, dtype=bool)
        first[self.begin[:-1]] = True
        return first[:-1]


class Model:
    """Log-likelihood ratios of two Kneser-Ney models that share their lowest level.

    ``tables`` are the sorted keys of each level (words, stems of six characters, of four) that the
    fitted documents hold; id 0 at a level is any other key.
    """

    def __init__(self, tables: list[np.ndarray], shared: list[np.ndarray]):
        """shared: corpus counts of id 0 (1: it falls out of the ratios) and of each key, at each level, and
        of all words."""
        self.tables, self.shared = tables, shared

    def ids(self, w: Words) -> list[np.ndarray]:
        out = []
        for table, keys in zip(self.tables, w.levels, strict=True):
            at, there = _lookup(table, keys)
            out.append(np.where(there, at + 1, 0))
        return out

    def fit(self, toxic: list[Words], ordinary: list[Words]) -> None:
        """Of a pair, how often it stands there; below, how many different words stand before a word (the
        start of a text is one), and before the words of a stem."""
        n = len(self.tables[0]) + 1
        six, four = (np.zeros(n, dtype=np.int64) for _ in range(2))
        pairs, types = [], []
        for of in (toxic, ordinary):
            both, starts = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
            for w in of:
                d = self.ids(w)
                six[d[0]], four[d[0]] = d[1], d[2]
                first = w.firsts()
                both.append((d[0][:-1] * n + d[0][1:])[~first[1:]])
                starts.append(d[0][first])
            keys, count = np.unique(np.concatenate(both), return_counts=True)
            pairs.append((keys, count))
            types.append(np.bincount(np.concatenate((keys % n, np.unique(np.concatenate(starts)))), minlength=n))
        self.lower, self.spare = [], []
        for c in types:
            own, spare = [], []
            for ids, table in zip((np.arange(n), six, four), self.tables, strict=True):
                k = np.bincount(ids, weights=c, minlength=len(table) + 1)
                k[0] = 0
                off = discount(k)
                total = max(k.sum(), 1.0)
                own.append(np.maximum(k - off, 0) / total)
                spare.append(max(np.minimum(k, off).sum() / total, 1e-3))
            self.lower.append(own)
            self.spare.append(spare)
        self.chance = [s / self.shared[3][0] for s in self.shared[:3]]
        self.pairs = np.union1d(pairs[0][0], pairs[1][0])
        self.pairs = self.pairs[(self.pairs // n > 0) & (self.pairs % n > 0)]
        left = self.pairs // n
        self.of_pair, self.gamma = [], []
        for keys, count in pairs:
            at, there = _lookup(keys, self.pairs)
            c = np.where(there, count[at], 0.0) if len(keys) else np.zeros(len(self.pairs))
            off = discount(count)
            total = np.bincount(left, weights=c, minlength=n)
            self.of_pair.append(np.maximum(c - off, 0) / np.maximum(total, 1.0)[left])
            self.gamma.append(np.where(total > 0, np.bincount(left, weights=np.minimum(c, off), minlength=n) / np.maximum(total, 1.0), 1.0).clip(1e-3, 1.0))

    def compact(self) -> Model:
        """The same in half the memory, for scoring."""
        out = Model(self.tables, [])
        half = lambda x: [half(y) for y in x] if isinstance(x, list) else np.asarray(x, dtype=np.float32)
        out.lower, out.of_pair, out.gamma, out.chance = (half(x) for x in (self.lower, self.of_pair, self.gamma, self.chance))
        out.spare, out.pairs, out.mean, out.scale, out.weights = self.spare, self.pairs, self.mean, self.scale, self.weights
        return out

    def probabilities(self, w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
        """In the toxic and in the ordinary model: of each word given the word before it, and of it alone."""
        _, first, which = np.unique(w.levels[0], return_index=True, return_inverse=True)
        kinds = Words.unpacked(np.concatenate([x[first] for x in w.levels]))  # each word of the texts once
        ids = self.ids(kinds)
        own_id = ids[0][which]
        alone = w.firsts()
        key = own_id[:-1] * (len(self.tables[0]) + 1) + own_id[1:]
        seen = np.flatnonzero((own_id[:-1] > 0) & (own_id[1:] > 0) & ~alone[1:])
        at, there = _lookup(self.pairs, key[seen])
        seen, at = seen[there], at[there]
        out = []
        for own, spare, of_pair, gamma in zip(self.lower, self.spare, self.of_pair, self.gamma, strict=True):
            p = own[2][ids[2]] + spare[2] * self.chance[2][ids[2]]
            for level in (1, 0):
                share = np.minimum(self.chance[level][ids[level]] / self.chance[level + 1][ids[level + 1]], 1.0)
                p = own[level][ids[level]] + spare[level] * share * p
            of_word = p[which]
            of_both = of_word.copy()
            if len(of_both) > 1:
                of_both[1:] *= np.where(alone[1:], 1.0, gamma[own_id[:-1]])
                of_both[seen + 1] += of_pair[at]
            out.append((of_both, of_word))
        return out

    def ratios(self, w: Words) -> np.ndarray:
        """Log ratio of each word, given the word before it."""
        (toxic, _), (ordinary, _) = self.probabilities(w)
        return np.log(toxic) - np.log(ordinary)

    def evidence(self, w: Words) -> np.ndarray:
        """For each text, the log ratio a word, and those of its most toxic words. 0 where there is none."""
        size = np.diff(w.begin)
        out, some = np.zeros((len(size), 1 + TOP)), np.flatnonzero(size > 0)
        if not len(some):
            return out
        start, size = w.begin[:-1][some], size[some]
        (toxic, toxic_word), (ordinary, ordinary_word) = self.probabilities(w)
        out[some, 0] = np.add.reduceat(np.log(toxic / ordinary), start) / size
        r = np.log(toxic_word / ordinary_word)
        order = np.lexsort((-r, np.repeat(np.arange(len(some)), size)))
        for i in range(TOP):
            has = size > i
            out[some[has], 1 + i] = r[order[start[has] + i]]
        return out

    def calibrate(self, docs: list[Words], toxic: np.ndarray, weight: np.ndarray) -> None:
        x = np.concatenate([self.evidence(d) for d in docs])
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
        x = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros(2 + TOP)
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2 + TOP)
            w += np.linalg.solve(h, x.T @ (weight * (toxic - p)) - 1e-2 * w)
        self.weights = w

    def score(self, w: Words) -> np.ndarray:
        """Of each text."""
        x = (self.evidence(w) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


@frugal
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [w.packed().view(np.int64) for part in slices(batch.column(0)) for w in map(Words, part)]
        sizes = pa.array([len(x) // 3 for x in got], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int64())), sizes, batch.column(1), batch.column(2)], names=["words", "n", "y", "h"])


class _Pairs:
    """Different pairs of a word and a word before it, and the stems of the words."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []  # word, left
        self.kinds: list[tuple[np.ndarray, ...]] = []  # word, six, four
        self.size = 0

    def add(self, word: np.ndarray, left: np.ndarray, kinds: tuple[np.ndarray, ...]) -> None:
        self.parts.append((word, left))
        self.kinds.append(kinds)
        self.size += len(word)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """Pairs in the order of their words, and each word once; nothing is left here."""
        kinds = [np.concatenate([k[i] for k in self.kinds]) for i in range(3)]
        self.kinds = []
        _, first = np.unique(kinds[0], return_index=True)
        kinds = tuple(k[first] for k in kinds)
        word, left = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        self.__init__()
        _, at = np.unique(mixed(word) + left, return_index=True)
        at = at[np.argsort(word[at], kind="stable")]
        return word[at], left[at], kinds


def _packed_pairs(word: np.ndarray, left: np.ndarray, kinds: tuple[np.ndarray, ...], buckets: int) -> Iterator[tuple[int, bytes]]:
    """The pairs of each bucket as bytes: how many words, the words, their stems, how many lefts each, the lefts."""
    bucket = mixed(kinds[0]) % np.uint64(buckets)
    count = np.diff(np.append(np.searchsorted(word, kinds[0]), len(word)))
    order = np.argsort(bucket, kind="stable")
    lefts = gather(left, (np.cumsum(count) - count)[order], count[order]).astype("<u4")
    count, bucket = count[order].astype("<u4"), bucket[order]
    own, *stems = (k[order].astype("<u8") for k in kinds)
    six, four = (x.view(np.uint8).reshape(-1, 8)[:, : STEM_BITS // 8] for x in stems)
    start = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    upto = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(own)], strict=True):
        yield int(bucket[a]), b"".join((np.uint32(b - a).tobytes(), own[a:b].tobytes(), six[a:b].tobytes(), four[a:b].tobytes(), count[a:b].tobytes(), lefts[upto[a] : upto[b]].tobytes()))


def _unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    n, wide = int(np.frombuffer(data, "<u4", 1)[0]), STEM_BITS // 8
    word = np.frombuffer(data, "<u8", n, 4)
    stems = np.zeros((2, n, 8), dtype=np.uint8)
    stems[:, :, :wide] = np.frombuffer(data, np.uint8, 2 * n * wide, 4 + 8 * n).reshape(2, n, wide)
    count = np.frombuffer(data, "<u4", n, 4 + 8 * n + 2 * n * wide)
    return np.repeat(word, count), np.frombuffer(data, "<u4", -1, 4 + 12 * n + 2 * n * wide), (word, *stems.view("<u8")[:, :, 0])


def corpus_counts(docs: DataFrame, scratch: Scratch, hot: np.ndarray | None = None) -> DataFrame:
    """word, six and four (its stems) and n, how many different words stand before it (the start of a text
    is one; words before it are told apart by 32 bits of their hash), for every word of every text: a
    distributed table that grows with the input. Words are dealt into buckets, whose number goes by the
    shuffle partitions; what a task has found of a bucket travels as one row. ``hot`` words go by the
    word before as well, into ``SALTS`` buckets."""
    spark, low = docs.sparkSession, np.uint64(SALTS - 1)
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(np.sort(hot) if hot is not None else np.empty(0, dtype=np.uint64))

    def rows(got: _Pairs) -> pa.RecordBatch:
        keys, data = zip(*_packed_pairs(*got.distinct(), buckets), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "pairs"])

    @frugal
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _Pairs()
        for batch in batches:
            for part in slices(batch.column(0)):
                w = Words(*part)
                if len(w):
                    left = mixed(np.concatenate((np.zeros(1, dtype=np.uint64), w.levels[0][:-1]))) >> np.uint64(32)
                    left[w.firsts()] = 0
                    word, six, four = w.levels
                    if len(shared.value):  # the last bits of a hot word are those of the word before
                        word = np.where(_lookup(shared.value, word)[1], word & ~low | left & low, word)
                    _, at = np.unique(mixed(word) + left, return_index=True)
                    _, one = np.unique(word, return_index=True)
                    got.add(word[at], left[at].astype(np.uint32), (word[one], six[one], four[one]))
                if got.size > PAIRS:
                    yield rows(got)
                    trim()
        if got.size:
            yield rows(got)

    def counted(got: _Pairs) -> pa.RecordBatch:
        word, _, (own, six, four) = got.distinct()
        n = np.diff(np.append(np.searchsorted(word, own), len(word)))
        at, is_hot = _lookup(shared.value & ~low, own & ~low)
        own = np.where(is_hot, shared.value[at], own) if len(shared.value) else own
        return pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (own, six, four)), pa.array(n, pa.int64()), pa.array(is_hot, pa.bool_())], names=["word", "six", "four", "n", "hot"])

    @frugal
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; several buckets are counted together."""
        got, last, apart = _Pairs(), None, 0
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if bucket != last and got.size > PAIRS // 4:
                    yield counted(got)
                    apart = 0
                last = bucket
                got.add(*_unpacked_pairs(data.as_py()))
                if got.size > PAIRS and got.size > 2 * apart:  # a bucket in very many rows
                    got.add(*got.distinct())
                    apart = got.size
        if got.size:
            yield counted(got)

    dealt = docs.select(F.col("text").cast("string")).mapInArrow(found, "bucket long, pairs binary").repartition("bucket").sortWithinPartitions("bucket")
    table = scratch.keep(dealt.mapInArrow(count, "word long, six long, four long, n long, hot boolean"), "counted")
    key = ["word", "six", "four"]
    return table.where("not hot").select(*key, "n").unionByName(table.where("hot").groupBy(*key).agg(F.sum("n").alias("n")))


def known_counts(corpus: DataFrame, tables: list[np.ndarray]) -> list[np.ndarray]:
    """Of ``corpus_counts``, the sum of all and of each key of the tables, at each level. No other count
    can change a score: where neither class has seen a key, the shared chance is a factor of both
    classes' probabilities and falls out of their ratio."""
    shared = corpus.sparkSession.sparkContext.broadcast(tables)
    counts = []
    for level, name in enumerate(("word", "six", "four")):

        @frugal
        def known(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                there = _lookup(shared.value[level], np.array(batch.column(0), dtype=np.int64).view(np.uint64))[1]
                yield batch.filter(pa.array(there, pa.bool_()))

        #: At most as many rows as the tables have keys.
        got = corpus.select(F.col(name).alias("key"), "n").mapInArrow(known, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        c = np.ones(len(tables[level]) + 1)
        c[_lookup(tables[level], np.array(got.column("key"), dtype=np.int64).view(np.uint64))[0] + 1] = np.array(got.column("n"))
        counts.append(c)
    total = corpus.agg(F.sum("n")).first()[0]
    shared.destroy()
    return [*counts, np.array([float(total or 1)])]


def _sampled(found: DataFrame, scratch: Scratch) -> tuple[list[Words], np.ndarray]:
    """The words and labels of the sample, in the order of the hash."""
    sizes = found.select("y", "h", "n").toArrow().sort_by("h")  # at most 2 * SAMPLE rows
    y, h, n = (np.array(sizes.column(c)) for c in ("y", "h", "n"))
    some = np.zeros(len(h), dtype=bool)
    for of in (0, 1):
        room = SAMPLE_WORDS
        for i in np.flatnonzero(y == of).tolist():
            if n[i] <= room:
                some[i], room = True, room - int(n[i])
    chosen = scratch.spark.createDataFrame([(int(x),) for x in h[some]], "chosen long")
    got = found.join(F.broadcast(chosen), F.col("h") == F.col("chosen"), "left_semi").select("words", "y", "h").toArrow().sort_by("h")
    lists = got.column("words").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)  # views of one buffer
    return [Words.unpacked(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.array(got.column("y"), dtype=np.int64)


def learn(docs: DataFrame, labels: DataFrame, label: str, train: Column, sample: int = SAMPLE) -> Model | None:
    """docs: doc_id, text; labels: doc_id and the 0/1 column; train: which doc_ids may be learnt from."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "toxicity")
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(train & F.col("y").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("doc_id", F.lit(5)))
    some = known.where("y = 1").orderBy("h", "doc_id").limit(sample).unionByName(known.where("y = 0").orderBy("h", "doc_id").limit(sample))
    #: At most 2 * sample ids, so the broadcast is bounded.
    got = docs.join(F.broadcast(scratch.keep(some, "sample")), "doc_id").groupBy("y", "h").agg(F.min("text").alias("text"))
    rows, y = _sampled(scratch.keep(got.select("text", "y", "h").mapInArrow(_packed, "words array<long>, n long, y int, h long"), "words"), scratch)
    if len(set(y.tolist())) < 2:
        return None
    held = np.arange(len(rows)) % 3 == 0
    tables = [np.unique(np.concatenate([w.levels[level] for w, h in zip(rows, held, strict=True) if not h])) for level in range(3)]
    each, often = np.unique(np.concatenate([w.levels[0] for w in rows]), return_counts=True)
    corpus = corpus_counts(docs, scratch, each[often * HOT_SHARE > often.sum()])
    model = Model(tables, known_counts(corpus, tables))
    pick = lambda of: [rows[i] for i in np.flatnonzero((y == of) & ~held)]
    model.fit(pick(1), pick(0))
    labelled = dict(known.groupBy("y").count().collect())
    weight = np.array([labelled[of] / max((y[held] == of).sum(), 1) for of in (0, 1)])
    model.calibrate([rows[i] for i in np.flatnonzero(held)], y[held], (weight / weight.max())[y[held]])
    scratch.drop("sample", "words", "counted")
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1) in place of any of that name; only texts leave the JVM."""
    spark = docs.sparkSession
    ship(spark)
    rest = docs.drop("score")
    if model is None:
        return rest.withColumn("score", F.lit(0.0))
    shared = spark.sparkContext.broadcast(model.compact())

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        m = shared.value
        for column in columns:
            yield pa.array(np.concatenate([np.empty(0), *(m.score(Words(*part)) for part in slices(column))]))
            trim()

    return rest.withColumn("score", F.arrow_udf(run, DoubleType())(F.col("text").cast("string")))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    few = docs.select("doc_id", "text")
    out = score(few, learn(few, labels, "toxic", ~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those predicted toxic; learns from every labelled row that ``scored`` learns from."""
    model = learn(docs.select("doc_id", "text"), labels, "toxic", ~held_out(F.col("doc_id")))
    columns = docs.columns
    own = [c for c in columns if c.lower() == "score"]
    renamed = docs.withColumnsRenamed({c: f"__own_{c}" for c in own})
    out = score(renamed, model).where(F.col("score") < threshold).drop("score")
    return out.withColumnsRenamed({f"__own_{c}": c for c in own}).select(*columns)
