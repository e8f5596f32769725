"""Language-model scores: causal self-attention on subword ids, next to a unigram base.

The model. Words are cut into ids of a public byte-level vocabulary. Every id
belongs to one of a few classes (frequent ids have their own, the others share
classes of equal weight). A causal self-attention model reads the ids before a place, each by a
vector of its own and that of its class. The probability of an id is that of its class times its share of the
class, both from the state of that model. Shares start from the counts of all training documents: what
followed an id of the class before counts, and shares whatever the context stand in for ``PRIOR`` more;
the state moves them by learned vectors. So every id has a context term of the whole window. The model is trained
in numpy from every id of every training document: replicas are trained where
the windows lie and averaged, weights by windows and vectors by how often they were met, for a few rounds. Texts are encoded once, and kept as
runs of documents that training and scoring read. Scoring slides overlapping windows over each document; every id is scored
once, with batched masked attention.

The base is exact: add-one smoothed unigram over whole words, counted over all
training documents. Words are dealt by hash in packed arrays, one entry per word
and run of documents; counts are summed there, and each run gets back the sums
of its documents. So the exchange grows with the table, a frequent word is one
entry per run, and no vocabulary is ever gathered.

A null text is empty: it has the end token only. A null id is in no fold, so it is
scored and not learned from. Repeated rows are learned and scored as often as they
occur. Without training documents all counts are 0. An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremetrics.llm.attention import CLASSES, WIDTH, WINDOW, Trainer, initial
from caremetrics.llm.language_id import fold
from caremetrics.llm.packing import by_bucket, dealt, rows_batch, run_numbers, NAMES, PACKED
from caremetrics.llm.subwords import IdScorer, Learner, Tree
from caremetrics.llm.words import SPACED_LOWER, Words, pieces
from caremetrics.session import work_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
IDS, END = 50_257, 50_256
ROUNDS, RATE, ROW_RATE, AT_ONCE = 3, 0.01, 0.05, 64
# Shares of the ids that replicas' vectors are averaged in.
PARTS = 32
# Windows that steps are cut from; the last step of a block is smaller.
BLOCK = 10_000
# Occurrences that the context-free shares of a class weigh in a context.
PRIOR = 100.0
_RUN = 4 << 20
_COUNTS, _USES, _DOCUMENTS, _TOTALS = 0, 1, 9, 8
_WEIGHTS, _INPUTS, _CHOICES = 0, 1, 2
_encoders: dict[str, tuple] = {}


def _encoder(path: str):
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        widths = np.zeros(IDS, dtype=np.int64)
        for piece, rank in ranks.items():
            widths[rank] = len(piece)
        _encoders[path] = encoding.encode_ordinary, widths
    return _encoders[path]


def _spelled(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, each with a blank before it, and how many each has.

    Words are encoded as one text and told apart by the bytes of their ids: no id
    reaches over a blank that stands between two words. Words with white space
    beyond ASCII in them could be joined to a neighbour, so they are encoded alone.
    """
    encode, widths = _encoder(path)
    alone = [i for i, w in enumerate(words) if len(w.split()) != 1]
    odd = {i: encode(" " + words[i]) for i in alone}
    plain = [" " + w for i, w in enumerate(words) if i not in odd] if odd else [" " + w for w in words]
    ids = np.array(encode("".join(plain)), dtype=np.int32)
    ends = np.cumsum(np.fromiter((len(w.encode()) for w in plain), np.int64, len(plain)))
    upto = np.searchsorted(np.cumsum(widths[ids]), ends) + 1
    sizes = np.diff(upto, prepend=0)
    if not odd:
        return ids, sizes
    parts = np.split(ids, upto[:-1])
    for i in alone:  # in order, so that earlier ones are in place
        parts.insert(i, np.array(odd[i], dtype=np.int32))
    parts = parts[: len(words)]
    return np.concatenate(parts), np.array([len(p) for p in parts])


class Run:
    """A run of documents: the hashes and subword ids of its distinct words, and which stand where.

    Every document is ended by the unit ``len(hashes)``, which is spelled ``END``.
    """

    def __init__(self, body: bytes):
        n, size, spelled, units = np.frombuffer(body, "<i8", 4)
        at = 32

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            at += (found := np.frombuffer(body, kind, count, at)).nbytes
            return found

        self.ids, self.bounds, self.hashes = part("<i8", n), part("<i8", n + 1), part("<u8", size)
        self.sizes, self.units, self.flat = part("<u4", size + 1), part("<u4", units), part("<u2", spelled)
        self.null, self.train = part("?", n), part("?", n)

    @staticmethod
    def packed(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, path: str) -> bytes:
        """Encode the texts of a run; each distinct word once."""
        words, n = Words(data, offsets, SPACED_LOWER), part.num_rows
        hashes, sample, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        raw = words.mapped.tobytes()
        at = zip(words.starts[sample].tolist(), words.ends[sample].tolist())
        flat, sizes = _spelled([raw[a:b].decode("utf-8", "replace") for a, b in at], path)
        units = np.full(len(words) + n, len(hashes), dtype="<u4")
        units[np.arange(len(words)) + words.documents()] = inverse
        ids = part.column("id")
        arrays = [
            np.array([n, len(hashes), len(flat) + 1, len(units)], "<i8"), ids.fill_null(0).to_numpy().astype("<i8"),
            (words.bounds + np.arange(n + 1)).astype("<i8"), hashes.astype("<u8"), np.append(sizes, 1).astype("<u4"),
            units, np.append(flat, END).astype("<u2"),
            ids.is_null().to_numpy(zero_copy_only=False), part.column("train").to_numpy(zero_copy_only=False),
        ]
        return b"".join(a.tobytes() for a in arrays)

    def spelled(self, units: np.ndarray) -> np.ndarray:
        """The subword ids of these units."""
        begin = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        lengths = self.sizes[units]
        ends = np.cumsum(lengths, dtype=np.int64)
        at = np.repeat(begin[units] - (ends - lengths), lengths)
        at += np.arange(len(at))
        return self.flat[at].astype(np.int32)

    def id_counts(self) -> np.ndarray:
        """How often each id occurs in training documents."""
        times = np.bincount(self._taught(), minlength=len(self.sizes))
        return np.bincount(self.flat, weights=np.repeat(times, self.sizes), minlength=IDS).astype(np.int64)

    def _taught(self) -> np.ndarray:
        return self.units[np.repeat(self.train, np.diff(self.bounds))]

    def windows(self) -> np.ndarray:
        """All windows of its training documents, after an end, one row each.

        Windows follow one another, so each id is predicted once; -1 fills the last.
        """
        ids = self.spelled(self._taught())
        seen = np.concatenate([[END], ids, np.full(WINDOW, -1)]).astype(np.int32)
        return seen[np.arange(0, len(ids), WINDOW)[:, None] + np.arange(WINDOW + 1)]

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """All subword ids, and the bounds of documents in them."""
        ends = np.concatenate([[0], np.cumsum(self.sizes[self.units], dtype=np.int64)])
        return self.spelled(self.units), ends[self.bounds]


def _encode(path: str):
    """Per task: the texts as packed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch, "text", _RUN):
                yield pa.RecordBatch.from_pydict({"body": pa.array([Run.packed(part, data, offsets, path)], pa.binary())})

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    for batch in batches:
        for body in batch.column("body"):
            yield Run(body.as_buffer())


def _blocks(runs: Iterator[Run]) -> Iterator[np.ndarray]:
    """The windows of all runs, ``BLOCK`` at a time."""
    held = np.empty((0, WINDOW + 1), dtype=np.int32)
    for own in runs:
        held = np.concatenate([held, own.windows()])
        while len(held) > BLOCK:
            yield held[:BLOCK]
            held = held[BLOCK:]
    if len(held):
        yield held


def _id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: counts of ids of training documents."""
    total = np.zeros(IDS, dtype=np.int64)
    for own in _runs(batches):
        total += own.id_counts()
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})


def _learn_from(path: str):
    """What texts teach, all of them training documents: counts of ids, and all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (pa.table({"text": b.column("text"), "id": pa.nulls(len(b), pa.int64()), "train": [True] * len(b)}) for b in batches)
        bodies = [b for t in texts for b in _encode(path)(iter(t.to_batches()))]
        for windows in _blocks(_runs(iter(bodies))):
            nothing = pa.nulls(len(windows), pa.int64())
            lists = pa.array(windows.tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict({"window": lists, "id": nothing.cast(pa.int32()), "n": nothing})
        for counts in _id_counts(iter(bodies)):
            lists = pa.nulls(len(counts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict({"window": lists, "id": counts.column("id"), "n": counts.column("n")})

    return run


class Model:
    """Classes of ids, the tree of choices within classes, the attention weights, and the vectors of ids and choices."""

    def __init__(self, counts: np.ndarray):
        order = np.lexsort((np.arange(IDS), -counts))
        own = CLASSES * 3 // 4
        self.classes = np.empty(IDS, dtype=np.int64)
        self.classes[order[:own]] = np.arange(own)
        rest = order[own:]
        mass = np.cumsum(counts[rest] + 1)
        self.classes[rest] = own + np.minimum((mass - 1) * (CLASSES - own) // mass[-1], CLASSES - own - 1)
        self.frequency = np.bincount(self.classes, weights=counts, minlength=CLASSES)
        smooth = np.bincount(self.classes, weights=counts + 1, minlength=CLASSES)
        self.plain = (counts + 1) / smooth[self.classes]
        self.weights, self.tree = initial(self.frequency), Tree(self.classes, counts)
        self.inputs, self.choices = np.zeros((IDS, WIDTH), np.float32), np.zeros((len(self.tree), WIDTH), np.float32)
        self.learn_contexts(np.zeros((CLASSES, IDS), dtype=np.int64))

    def learn_contexts(self, pairs: np.ndarray) -> None:
        """What choices start from: counts of ids after ids of each class."""
        self.tree.weigh(pairs.T + PRIOR * self.plain[:, None])

    @property
    def share(self) -> np.ndarray:
        """Log shares that choices start from (class of the id before, id); those of a class sum to one in every context."""
        return self.tree.shares()

    def scores(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """log10 probability of each document of a stream of ids."""
        if not len(ids):
            return np.zeros(len(bounds) - 1)
        scorer = IdScorer(self.weights, self.classes, self.tree, self.inputs, self.choices)
        told = scorer.stream(ids, END, bounds)  # a document follows the end of another
        total = np.concatenate([[0.0], np.cumsum(told, dtype=np.float64)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / log(10)


def encoded(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """The runs of ``documents`` (columns id, train, text), written once: training and scoring read them."""
    spark = documents.sparkSession
    folder = work_dir(spark, "subwords")
    packed = documents.mapInArrow(_encode(path), "body binary")
    # Groups of a few runs, so that few are read at once.
    groups = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}
    packed.write.options(compression="zstd", **groups).parquet(folder)
    return spark.read.parquet(folder)


def train(documents: DataFrame, path: str = VOCABULARY) -> Model:
    """Count ids and fit the attention model, over all of ``documents`` (column text)."""
    return fit(encoded(documents.select(F.lit(None).cast("long").alias("id"), F.lit(True).alias("train"), "text"), path))


def fit(stored: DataFrame) -> Model:
    """Count ids and fit the attention model, over all training documents of packed runs."""
    counts = np.zeros(IDS, dtype=np.int64)
    counted = stored.mapInArrow(_id_counts, "id int, n long")
    summed = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # at most IDS rows
    counts[summed["id"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)
    model = Model(counts)
    model.learn_contexts(_pairs(stored, model.classes))
    for _ in range(ROUNDS):
        if not _round(stored, model):
            break
    return model


def _pairs(stored: DataFrame, classes: np.ndarray) -> np.ndarray:
    """How often each id follows an id of each class: a fixed number of counts."""
    shared = stored.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * IDS, dtype=np.int64)
        for own in _runs(batches):
            ids = own.windows()
            counted = ids[:, 1:] >= 0
            total += np.bincount(shared.value[ids[:, :-1][counted]] * IDS + ids[:, 1:][counted], minlength=CLASSES * IDS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    summed = stored.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most CLASSES * IDS rows
    pairs = np.zeros(CLASSES * IDS, dtype=np.int64)
    pairs[summed["pair"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)
    return pairs.reshape(CLASSES, IDS)


def _round(stored: DataFrame, model: Model) -> bool:
    """Train a replica per task on the task's windows, and give the model their means; False without windows.

    Weights are averaged by windows seen. The change of a vector is averaged by how often
    replicas met it, and only those that did send it.
    """
    shared = stored.sparkSession.sparkContext.broadcast((model.classes, model.weights, model.tree, model.inputs, model.choices))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, weights, tree, inputs, choices = shared.value
        trainer, words, n = Trainer(weights, RATE), Learner(tree, inputs, choices, ROW_RATE), 0
        for ids in _blocks(_runs(batches)):
            found = classes[np.maximum(ids, 0)]
            seen, aim = found[:, :-1].copy(), found[:, 1:].copy()
            counted = ids[:, 1:] >= 0
            for at in range(0, len(found), AT_ONCE):
                some = slice(at, at + AT_ONCE)
                places = words.at(ids[some, :-1].clip(0), ids[some, 1:], seen[some], counted[some])
                trainer.step(seen[some], aim[some], counted[some], places)
            n += len(found)
        if n:
            number = next(run_numbers())
            yield rows_batch([(0, _WEIGHTS, number, _replica_part(np.array([0]), np.array([n]), trainer.weights[None]))])
            for kind, held in ((_INPUTS, words.inputs), (_CHOICES, words.choices)):
                met = np.flatnonzero(held.met)
                change = (held.values[met] - held.start[met]).astype(np.float16)
                edges = np.searchsorted(met, np.arange(PARTS + 1) * (len(held.met) // PARTS + 1))
                parts = [(i, slice(a, b)) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                yield rows_batch([(kind * PARTS + i, kind, number, _replica_part(met[p], held.met[met[p]], change[p])) for i, p in parts])

    replicas = stored.mapInArrow(run, PACKED)
    found = replicas.repartition("bucket").sortWithinPartitions("bucket", "run").mapInArrow(_means, PACKED)
    rows = found.toPandas()  # the size of the model
    for kind, body in zip(rows["kind"], rows["body"]):
        at, _, means = _opened(body)
        if kind == _WEIGHTS:
            model.weights = means[0]
        else:
            (model.inputs if kind == _INPUTS else model.choices)[at] += means
    return len(rows) > 0


def _replica_part(at: np.ndarray, times: np.ndarray, rows: np.ndarray) -> bytes:
    head = np.array([len(at), rows.shape[1], rows.itemsize], "<i8")
    return b"".join(a.tobytes() for a in (head, at.astype("<u4"), times.astype("<i8"), rows))


def _opened(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, width, size = np.frombuffer(body, "<i8", 3).tolist()
    rows = np.frombuffer(body, f"<f{size}", n * width, 24 + 12 * n)
    return np.frombuffer(body, "<u4", n, 24), np.frombuffer(body, "<i8", n, 24 + 4 * n), rows.reshape(n, width).astype(np.float32)


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: mean rows of the replicas, by the times that go with them."""
    current = None

    def finished() -> pa.RecordBatch:
        at = np.flatnonzero(times)
        return rows_batch([(*current, 0, _replica_part(at, times[at], (total[at] / times[at, None]).astype(np.float32)))])

    for batch in batches:
        for bucket, kind, _, body in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            at, n, rows = _opened(body)
            if (bucket, kind) != current:
                if current is not None:
                    yield finished()
                current = bucket, kind
                times, total = np.zeros(IDS, np.int64), np.zeros((IDS if kind else 1, rows.shape[1]))
            times[at] += n
            total[at] += rows.astype(np.float64) * n[:, None]
    if current is not None:
        yield finished()


def _score_and_pack(model, buckets: int):
    """Score the documents of a run, and send its words to where they are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = run_numbers()
        for own in _runs(batches):
            n, size, tokens = len(own.ids), len(own.hashes), np.diff(own.bounds)
            inverse = own.units[own.units < size].astype(np.int64)
            doc = np.repeat(np.arange(n), tokens - 1)
            taught = np.bincount(inverse[own.train[doc]], minlength=size)
            uses, times = np.unique(inverse * n + doc, return_counts=True)
            used = uses // n
            edges = np.searchsorted(used, np.arange(size + 1))
            number, rows = next(numbers), []
            for bucket, chosen in by_bucket(own.hashes, buckets):
                counted = chosen[taught[chosen] > 0]
                if len(counted):
                    rows.append((bucket, _COUNTS, number, own.hashes[counted].tobytes() + taught[counted].astype("<i8").tobytes()))
                lengths = edges[chosen + 1] - edges[chosen]
                at = np.repeat(edges[chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
                head = np.array([len(chosen), len(at), n], dtype="<i8").tobytes()
                body = [own.hashes[chosen], lengths.astype("<u4"), (uses[at] % n).astype("<u4"), times[at].astype("<u4")]
                rows.append((bucket, _USES, number, head + b"".join(x.tobytes() for x in body)))
            score = model.value.scores(*own.stream())
            head = np.concatenate([[n], own.ids, own.null, tokens]).astype("<i8")
            rows.append((number % buckets, _DOCUMENTS, number, head.tobytes() + score.astype("<f8").tobytes()))
            yield rows_batch(rows)

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: sum the counts, then answer each run with sums over its documents."""
    current, held = None, []
    keys = counts = logs = None

    def merged() -> tuple[np.ndarray, np.ndarray]:
        if not held:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        both = [np.frombuffer(b, np.uint64).reshape(2, -1) for b in held]
        keys, inverse = np.unique(np.concatenate([b[0] for b in both]), return_inverse=True)
        return keys, np.bincount(inverse, weights=np.concatenate([b[1].view(np.int64) for b in both])).astype(np.int64)

    for batch in batches:
        out = []
        for bucket, kind, number, body in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            if bucket != current:
                current, held, keys = bucket, [], None
            if kind == _DOCUMENTS:
                out.append((bucket, kind, number, body))
            elif kind == _COUNTS:
                held.append(body)
                if len(held) > 200:
                    k, c = merged()
                    held[:] = [k.tobytes() + c.tobytes()]
            else:
                if keys is None:
                    keys, counts = merged()
                    held, logs = [], np.log10(counts + 1.0)
                    out.append((bucket, _TOTALS, -1, np.array([counts.sum(), len(keys)], dtype="<i8").tobytes()))
                size, uses, n = np.frombuffer(body[:24], "<i8")
                words = np.frombuffer(body, np.uint64, size, 24)
                lengths, docs, times = np.split(np.frombuffer(body, "<u4", size + 2 * uses, 24 + 8 * size), [size, size + uses])
                known, value = np.zeros(size, dtype=bool), np.zeros(size)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
                    known = keys[at] == words
                    value = np.where(known, logs[at], 0.0)
                sums = np.bincount(docs, weights=np.repeat(value, lengths) * times, minlength=n)
                met = np.bincount(docs, weights=np.repeat(known, lengths) * times, minlength=n)
                out.append((bucket, _USES, number, sums.astype("<f8").tobytes() + met.astype("<f8").tobytes()))
        yield rows_batch(out)


def _answers(train_words: int, vocabulary: int, train_documents: int):
    """Per run: add up what the buckets sent, and finish the documents."""
    n_all = train_words + train_documents
    smooth = np.log10(n_all + 1.0 * (vocabulary + (train_documents > 0) + 1))
    names = ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def finished(body: bytes, sums: np.ndarray | None) -> pa.RecordBatch:
        n = int(np.frombuffer(body[:8], "<i8")[0])
        ids, null, tokens = np.frombuffer(body, "<i8", 3 * n, 8).reshape(3, n)
        score = np.frombuffer(body, "<f8", n, 8 + 24 * n)
        total = sums if sums is not None else np.zeros((2, n))
        base = total[0] + np.log10(train_documents + 1.0) - tokens * smooth
        known = total[1].astype(np.int64) + (train_documents > 0)
        arrays = [pa.array(ids, mask=null.astype(bool)), pa.array(tokens), pa.array(known), pa.array(np.full(n, n_all)), pa.array(base), pa.array(score)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums, body = None, None, None
        for batch in batches:
            for kind, number, value in zip(*(batch.column(c).to_pylist() for c in NAMES[1:])):
                if number != current:
                    if body is not None:
                        yield finished(body, sums)
                    current, sums, body = number, None, None
                if kind == _DOCUMENTS:
                    body = value
                else:
                    part = np.frombuffer(value, "<f8").reshape(2, -1)
                    sums = part.copy() if sums is None else sums + part
        if body is not None:
            yield finished(body, sums)

    return run


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, path: str = VOCABULARY
) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(fold(id_col, folds) != held, F.lit(False)).alias("train"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    learned = needed.where("train")
    stored = encoded(needed, path)
    model = spark.sparkContext.broadcast(fit(stored))
    packed = stored.mapInArrow(_score_and_pack(model, buckets), PACKED)
    folder = work_dir(spark, "counts")
    dealt(packed, "bucket").mapInArrow(_count, PACKED).write.parquet(folder)
    counted = spark.read.parquet(folder)
    totals = counted.where(F.col("kind") == _TOTALS).select("body").toLocalIterator()
    words = vocabulary = 0
    for row in totals:  # one row per bucket
        n, v = np.frombuffer(bytes(row["body"]), "<i8")
        words, vocabulary = words + int(n), vocabulary + int(v)
    answers = _answers(words, vocabulary, learned.count())
    rest = counted.where(F.col("kind") != _TOTALS)
    scored = dealt(rest, "run").mapInArrow(
        answers, "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    held_out = F.coalesce(fold("id", folds) == held, F.lit(False))
    return scored.select(
        F.col("id").alias(id_col), held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
