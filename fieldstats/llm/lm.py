"""Language-model scoring: interpolated modified Kneser-Ney trigrams, counted in Spark.

Every token of a text has a trigram (two start marks before the text, one end token after it).
Tasks hash their texts' n-grams in blocks, combine equal ones and send each hash once to the part
of the hash range it belongs to; a part adds up its n-grams, sorts them and writes numpy arrays to
the shared folder. Workers map the arrays of one pass into memory for the next one:

1. trigrams with their counts;
2. bigrams: a position of the text tells the counts of the trigram that ends there and of the one
   that goes on from there. A trigram counted c times is met at c positions, so each adds 1 / c
   of a type; the sums over a bigram's positions are its continuation count and the N's;
3. words, from the bigrams in the same way (a plain aggregation of one row per word and task);
4. scores: the n-grams of each text are looked up and summed within its task.

Lookups are shared: a task gathers the n-grams of many blocks of texts, sorts them and searches
each distinct one once; what a score needs of one n-gram alone is worked out once for it.

An n-gram met once in training is stored only if a text outside the training rows holds it too:
a training text that holds an n-gram which is not stored is itself the one place where it occurs.
Shuffled hashes are sorted and kept as differences, bytes of equal weight together, which
compresses well; a stored table keeps each distinct row of values once, and a short code per key.

Model, per token w after context (u, v); c: counts, cc: continuation counts, T: sums over a
context, N1/N2/N3: its types seen once, twice, three times or more:

* P1(w) = max(cc(w) - D1, 0) / T1 + g1 / (V + 1), g1 = (D1_1 n1 + D1_2 n2 + D1_3 n3+) / T1
  (V + 1: the training vocabulary and one slot for unseen tokens);
* P2(w | v) = max(cc(v w) - D2, 0) / T2(v) + g2(v) P1(w), or P1(w) where v never preceded a token;
* P3(w | u v) = max(c(u v w) - D3, 0) / T3(u v) + g3(u v) P2(w | v), or P2 likewise.

Discounts: D_k = k - (k + 1) Y n_{k+1} / n_k with Y = n1 / (n1 + 2 n2), held inside
[``MIN_DISCOUNT``, k] (so that tiny corpora keep mass for unseen tokens); 0 / 0 counts as 0.
The base score is the add-one unigram: log10((c + 1) / (N + V + 1)).

Hard cases: a null text is empty and scores its end token alone; texts are whole, however long;
tokens are lower-cased (A-Z) runs between white space (space, tab to carriage return); the start
and end marks are white space, so no word can equal them. Repeated rows are scored alike and
counted as often as they appear; a table without training rows gives every token probability
1 and base 1 / 1. An empty table gives no rows. Extra columns are carried by the caller.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldstats.llm.components import released, stored
from fieldstats.llm.words import Hasher, blocks, mix
from fieldstats.session import scratch_path

MIN_DISCOUNT = 0.1
#: Tokens whose n-grams a task holds before it combines and passes them on (8 to 24 bytes each).
AT_ONCE = 1 << 21
#: Tokens that a task scores at once.
SCORE_AT_ONCE = 1 << 19
#: Parts of the hash range for each partition that the texts are read in.
PARTS_PER_SPLIT = 4
#: Rows of one sorted array file; a table of R rows is written as about R / FILE_ROWS files.
FILE_ROWS = 1_000_000
UNI = ["c", "cc", "t", "n1", "n2", "n3"]
BI = ["c", "cc", "t", "n1", "n2", "n3"]
TRI = ["c"]
_START, _END = mix(np.arange(1, 3, dtype=np.uint64))
_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_TOP = np.uint64(1 << 63)


@dataclass
class Grams:
    """The tokens of some texts in order: text, hashes of the token itself, the last two and the last three."""

    owner: np.ndarray
    w: np.ndarray
    vw: np.ndarray
    uvw: np.ndarray
    first: np.ndarray  # whether the token begins its text
    last: np.ndarray


#: The two start marks, the context of every first token.
_STARTS = mix(np.array([_START], dtype=np.uint64) * _PLACE[0] + np.array([_START], dtype=np.uint64) * _PLACE[1] + np.uint64(2))


def grams(hasher: Hasher, texts: list[bytes]) -> Grams:
    """Lower-cased (A-Z) words of the whole texts, each with the end token, and their n-grams."""
    owner, word = hasher.words(texts)
    sizes = np.bincount(owner, minlength=len(texts)) + 1
    ends = np.cumsum(sizes + 2)
    begins = np.r_[0, ends[:-1]]
    tokens = np.empty(ends[-1], dtype=np.uint64)
    tokens[begins] = tokens[begins + 1] = _START
    tokens[ends - 1] = _END
    tokens[np.arange(len(word)) + 3 * owner + 2] = word
    real = np.ones(len(tokens), dtype=bool)
    real[begins] = real[begins + 1] = False
    at = np.flatnonzero(real)
    u, v, w = tokens[at - 2], tokens[at - 1], tokens[at]
    first, last = np.zeros(len(at), dtype=bool), np.zeros(len(at), dtype=bool)
    stop = np.cumsum(sizes)
    first[stop - sizes] = last[stop - 1] = True
    return Grams(
        owner=np.repeat(np.arange(len(texts)), sizes),
        w=w,
        vw=mix(v * _PLACE[0] + w * _PLACE[1] + np.uint64(2)),
        uvw=mix(u * _PLACE[0] + v * _PLACE[1] + w * _PLACE[2] + np.uint64(3)),
        first=first,
        last=last,
    )


def _texts(batches) -> Iterator[tuple[Grams, np.ndarray]]:
    """N-grams of blocks of texts (text, train), and whether each token is for training."""
    hasher = Hasher()
    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for first, texts in blocks(batch.column(0)):
            found = grams(hasher, texts)
            yield found, train[first : first + len(texts)][found.owner]


def _columns(batches, pick) -> Iterator[list[np.ndarray]]:
    """What ``pick`` takes of each block of texts, column by column, for ``AT_ONCE`` tokens or one block that has more."""
    held, n = [], 0
    for found, train in _texts(batches):
        held.append(pick(found, train))
        n += len(train)
        if n >= AT_ONCE:
            yield _joined(held)
            held, n = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    columns = [list(x) for x in zip(*held, strict=True)]
    held.clear()
    out = []
    while columns:  # a joined column's blocks are given up
        out.append(np.concatenate(columns.pop(0)))
    return out


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, their lowest bytes first, then the next ones, and so on."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(blobs: list[bytes]) -> np.ndarray:
    parts = [np.frombuffer(b, dtype=np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel() for b in blobs if b]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unstepped(blobs: list[bytes]) -> np.ndarray:
    parts = [np.cumsum(_unplaned([b]), dtype=np.uint64) for b in blobs if b]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.uint64)


def _cells(columns: dict[str, tuple[np.ndarray, np.ndarray | None]], parts: int) -> pa.RecordBatch:
    """One row per part of the hash range: of each column (sorted keys, values or None for the keys) what lies in it."""
    bounds = np.array([-(-(p << 64) // parts) for p in range(1, parts)], dtype=np.uint64)
    rows = {"part": np.arange(parts)}
    for name, (keys, values) in columns.items():
        cut = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
        rows[name] = [_steps(keys[a:b]) if values is None else _planes(values[a:b]) for a, b in zip(cut, cut[1:])]
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64())] + [(c, pa.binary()) for c in columns]))


def _gathered(batches, columns: list[str]) -> Iterator[tuple[int, dict[str, list[bytes]]]]:
    """The blobs of each part."""
    held: dict[int, dict[str, list[bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            own = held.setdefault(row["part"], {c: [] for c in columns})
            for c in columns:
                own[c].append(row[c])
    while held:
        yield held.popitem()


def _schema(columns: list[str]) -> str:
    return "part long, " + ", ".join(f"{c} binary" for c in columns)


def _runs(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(sorted_columns[0]), dtype=bool)
    new[:1] = True
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _ordered(keys: np.ndarray, ends: np.ndarray, goes: np.ndarray) -> np.ndarray:
    """Order by key, ends and goes, of rows that are in order of their keys."""
    if not len(keys):
        return np.empty(0, dtype=np.int64)
    run = np.zeros(len(keys), dtype=np.int64)
    run[_runs(keys)] = 1
    run = np.cumsum(run)
    wide, high = int(goes.max()) + 1, int(ends.max()) + 1
    if (int(run[-1]) + 1) * wide * high >= 1 << 63:  # too large for one number
        return np.lexsort((goes, ends, run))
    return np.argsort((run * high + ends) * wide + goes)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[_runs(keys)]


_TRI_CELLS = ["one", "more", "times", "held"]


def _trigram_blocks(parts: int):
    def packed(ours: list[np.ndarray], held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(ours))
        first = _runs(keys)
        times = np.diff(first, append=len(keys)).astype(np.uint64)
        keys = keys[first]
        one = times == 1
        more = keys[~one]
        return _cells({"one": (keys[one], None), "more": (more, None), "times": (more, times[~one]), "held": (_distinct(np.concatenate(held)), None)}, parts)

    def run(batches):
        ours, held, n = [], [], 0
        for found, train in _texts(batches):
            ours.append(found.uvw[train])
            held.append(found.uvw[~train])
            n += len(train)
            if n >= AT_ONCE:
                yield packed(ours, held)
                ours, held, n = [], [], 0
        if n:
            yield packed(ours, held)

    return run


def _trigram_tables(folder: str):
    def run(batches):
        for p, own in _gathered(batches, _TRI_CELLS):
            one = _unstepped(own["one"])
            keys = np.r_[one, _unstepped(own["more"])]
            times = np.r_[np.ones(len(one), dtype=np.int64), _unplaned(own["times"]).astype(np.int64)]
            order = np.argsort(keys)
            keys, times = keys[order], times[order]
            first = _runs(keys)
            keys, times = keys[first], np.add.reduceat(times, first) if len(first) else times
            keep = (times > 1) | np.isin(keys, _distinct(_unstepped(own["held"])), assume_unique=True)
            yield _file(folder, p, keys[keep], times[keep, None], times)

    return run


_BI_CELLS = ["once", "key", "ends", "goes", "times", "held"]


def _bigram_blocks(trigrams, parts: int):
    """Per bigram: positions by the counts of the trigram that ends there and of the one that goes on (0: none)."""

    def positions(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows, at = lookup(trigrams.value, len(TRI), columns.pop(0))
        vw, first, last, train = columns
        columns.clear()  # nothing is held for the packing but what is returned
        count = np.maximum(rows[:, 0], 1)[at]
        goes = np.where(last, 0, np.r_[count[1:], 0])
        starts = first & train
        begin = np.full(int(starts.sum()), _STARTS[0])
        ends = np.r_[count[train], np.zeros(len(begin), dtype=np.int64)]
        return np.r_[vw[train], begin], ends, np.r_[goes[train], count[starts]], _distinct(np.r_[vw[~train], _STARTS])

    def packed(keys, ends, goes, held) -> pa.RecordBatch:
        order = np.argsort(keys)
        keys, ends, goes = keys[order], ends[order], goes[order]
        first = _runs(keys)
        once = np.zeros(len(keys), dtype=bool)
        once[first] = np.diff(first, append=len(keys)) == 1
        once &= (ends == 1) & (goes == 1)
        plain = keys[once]
        keys, ends, goes = keys[~once], ends[~once], goes[~once]
        order = _ordered(keys, ends, goes)
        ends, goes = ends[order], goes[order]  # the keys are in order already
        first = _runs(keys, ends, goes)
        times = np.diff(first, append=len(keys))
        keys = keys[first]
        cells = {"once": (plain, None), "key": (keys, None), "ends": (keys, ends[first]), "goes": (keys, goes[first]), "times": (keys, times)}
        return _cells(cells | {"held": (held, None)}, parts)

    def run(batches):
        for columns in _columns(batches, lambda f, train: (f.uvw, f.vw, f.first, f.last, train)):
            yield packed(*positions(columns))

    return run


def _types(count: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """``weight`` where the count is 1, 2, 3 or more."""
    return [np.where(count == 1, weight, 0.0), np.where(count == 2, weight, 0.0), np.where(count >= 3, weight, 0.0)]


def _bigram_tables(folder: str):
    def run(batches):
        for p, own in _gathered(batches, _BI_CELLS):
            plain = _unstepped(own["once"])
            ones = np.ones(len(plain), dtype=np.int64)
            keys = np.r_[plain, _unstepped(own["key"])]
            order = np.argsort(keys)
            ends, goes, times = (np.r_[ones, _unplaned(own[c]).astype(np.int64)][order] for c in ("ends", "goes", "times"))
            keys = keys[order]
            first = _runs(keys)
            keys = keys[first]
            share = times / np.maximum(goes, 1)
            parts = [np.where(ends > 0, times, 0), np.where(ends > 0, times / np.maximum(ends, 1), 0.0), np.where(goes > 0, times, 0), *_types(goes, share)]
            # whole numbers, but for rounding of the 1 / c
            values = np.stack([np.rint(np.add.reduceat(x, first)).astype(np.int64) for x in parts], axis=1) if len(first) else np.empty((0, len(BI)), dtype=np.int64)
            keep = (values[:, 0] != 1) | np.isin(keys, _distinct(_unstepped(own["held"])), assume_unique=True)
            yield _file(folder, p, keys[keep], values[keep], values[:, 1])

    return run


def _words(bigrams):
    """Rows (h, UNI) per word of some texts: occurrences, and shares of the types of bigrams that end and begin with it."""

    def summed(columns: list[np.ndarray]) -> pa.RecordBatch:
        rows, at = lookup(bigrams.value, len(BI), columns.pop())
        w, first = columns
        c, cc = np.maximum(rows[:, 0], 1), np.maximum(rows[:, 1], 1)
        share, begun, kind = (1.0 / c)[at], (cc / c)[at], (np.minimum(cc, 3) - 1)[at]
        keys, at_w = np.unique(w, return_inverse=True)
        keys = np.r_[keys, _START]
        at_v = np.r_[0, at_w[:-1]][: len(at_w)]
        at_v[first] = len(keys) - 1
        types = np.bincount(3 * at_v + kind, share, 3 * len(keys)).reshape(-1, 3)
        sums = [np.bincount(at_w, minlength=len(keys)), np.bincount(at_w, share, len(keys)), np.bincount(at_v, begun, len(keys)), *types.T]
        return pa.RecordBatch.from_pydict({"h": (keys ^ _TOP).view(np.int64)} | {c: x.astype(float) for c, x in zip(UNI, sums, strict=True)})

    def run(batches):
        for columns in _columns(batches, lambda f, train: (f.w[train], f.first[train], f.vw[train])):
            yield summed(columns)

    return run


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of types counted 1, 2, 3 and 4 times."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(min(float(k), max(MIN_DISCOUNT, d)))
    return out


@dataclass
class Model:
    """Where the sorted arrays lie, and the numbers of the whole training text."""

    tables: dict[str, list[tuple[int, str]]]
    d1: list[float]
    d2: list[float]
    d3: list[float]
    total: int  # N: training tokens
    vocabulary: int  # V
    t1: int  # sum of continuation counts of single tokens
    g1: float


def _local(folder: str) -> str:
    local = folder[len("file:") :] if folder.startswith("file:") else folder
    if "://" in local:
        raise ValueError("the arrays are memory-mapped: spark.checkpoint.dir must be a mounted shared folder")
    return local


def _save(local: str, keys: np.ndarray, values: np.ndarray) -> str:
    """Sorted keys, the distinct rows of values, and which of them belongs to each key."""
    table = pd.DataFrame(values)
    codes = table.groupby(list(table.columns), sort=False).ngroup().to_numpy()
    rows = table.drop_duplicates().to_numpy(np.int64)
    stem = f"{local}/{int(keys[0]):020d}"
    os.makedirs(local, exist_ok=True)
    for suffix, array in ((".keys.npy", keys), (".rows.npy", rows), (".codes.npy", codes.astype(np.min_scalar_type(len(rows))))):
        tmp = f"{stem}.{os.getpid()}.tmp.npy"
        np.save(tmp, np.ascontiguousarray(array))
        os.replace(tmp, stem + suffix)
    return stem


_FILE = "first decimal(20,0), stem string, n1 long, n2 long, n3 long, n4 long"


def _file(folder: str, part: int, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Writes a part; its row has the first key, the file's name and how many n-grams are counted 1 to 4 times."""
    stem = _save(_local(folder), keys, values) if len(keys) else None
    row = {"first": pa.array([int(keys[0]) if stem else None], pa.decimal128(20, 0)), "stem": pa.array([stem], pa.string())}
    return pa.RecordBatch.from_pydict(row | {f"n{k}": [int((counts == k).sum())] for k in range(1, 5)})


def _write_sorted(df: DataFrame, key: str, columns: list[str], folder: str, rows: int) -> list[tuple[int, str]]:
    """Range-partition by key, sort and write each part; returns (first key, stem)."""
    parts = max(1, -(-rows // FILE_ROWS))
    local = _local(folder)

    def write(batches):
        chunks = list(batches)
        if not chunks or not sum(len(c) for c in chunks):
            return
        data = pd.concat(chunks, ignore_index=True)
        keys = data[key].to_numpy(np.int64).view(np.uint64) ^ _TOP
        yield pd.DataFrame({"first": [str(keys[0])], "stem": [_save(local, keys, data[columns].to_numpy(np.int64))]})

    ordered = df.select(key, *columns).repartitionByRange(parts, key).sortWithinPartitions(key)
    written = ordered.mapInPandas(write, "first string, stem string").collect()  # one row per file
    return sorted((int(r["first"]), r["stem"]) for r in written)


def _table(packed: DataFrame, parts: int, tables, folder: str) -> tuple[list[tuple[int, str]], list[int]]:
    """Deals the blocks to the parts, which write their arrays: (first key, stem) of each file, and counts of counts."""
    files = stored(packed.repartition(parts, "part").mapInArrow(tables(folder), _FILE), "lm-files")
    rows = files.collect()  # one row per part
    released(files)
    return sorted((int(r["first"]), r["stem"]) for r in rows if r["stem"]), [sum(r[f"n{k}"] for r in rows) for k in range(1, 5)]


def fit(spark, docs: DataFrame) -> Model:
    """Count the training texts among ``docs`` (text, train) and write the model's arrays, as far as ``docs`` need them."""
    folder = scratch_path(spark, "lm")
    _local(folder)
    parts = max(PARTS_PER_SPLIT * docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    tri, n3 = _table(docs.mapInArrow(_trigram_blocks(parts), _schema(_TRI_CELLS)), parts, _trigram_tables, f"{folder}/tri")
    told = spark.sparkContext.broadcast(tri)
    bi, n2 = _table(docs.mapInArrow(_bigram_blocks(told, parts), _schema(_BI_CELLS)), parts, _bigram_tables, f"{folder}/bi")
    told = spark.sparkContext.broadcast(bi)
    each = docs.mapInArrow(_words(told), "h long, " + ", ".join(f"{c} double" for c in UNI))
    uni = stored(each.groupBy("h").agg(*[F.rint(F.sum(c)).cast("long").alias(c) for c in UNI]), "unigrams")
    counted = {"v": F.col("c") > 0, "more": F.col("cc") >= 3} | {f"n{k}": F.col("cc") == k for k in range(1, 5)}
    totals = uni.agg(
        F.sum("c").alias("n"), F.sum("cc").alias("t1"), F.count(F.lit(1)).alias("rows"), *[F.count_if(x).alias(c) for c, x in counted.items()]
    ).first()
    n1 = [totals[f"n{k}"] for k in range(1, 5)]
    d1 = discounts(n1)
    t1 = int(totals["t1"] or 0)
    g1 = (d1[0] * n1[0] + d1[1] * n1[1] + d1[2] * totals["more"]) / t1 if t1 else 1.0
    return Model(
        tables={"uni": _write_sorted(uni, "h", UNI, f"{folder}/uni", totals["rows"]), "bi": bi, "tri": tri},
        d1=d1,
        d2=discounts(n2),
        d3=discounts(n3),
        total=int(totals["n"] or 0),
        vocabulary=int(totals["v"] or 0),
        t1=t1,
        g1=g1,
    )


_MAPPED: dict[str, np.ndarray] = {}


def _mapped(path: str) -> np.ndarray:
    if path not in _MAPPED:
        _MAPPED[path] = np.asarray(np.load(path, mmap_mode="r"))  # a plain array over the map: cheaper to index
    return _MAPPED[path]


def lookup(parts: list[tuple[int, str]], width: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the distinct hashes (zeros where absent), from the memory-mapped sorted arrays, and each hash's row in them."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    new = _runs(hashes)
    at_hash = np.empty(len(hashes), dtype=np.int64)
    at_hash[order] = np.repeat(np.arange(len(new)), np.diff(new, append=len(hashes)))
    hashes = hashes[new]
    del order, new
    out = np.zeros((len(hashes), width), dtype=np.int64)
    if not parts or not len(hashes):
        return out, at_hash
    cut = np.searchsorted(hashes, np.array([p[0] for p in parts], dtype=np.uint64)).tolist()
    for (_, stem), a, b in zip(parts, cut, [*cut[1:], len(hashes)], strict=True):
        if a < b:
            keys, codes, rows = (_mapped(f"{stem}.{name}.npy") for name in ("keys", "codes", "rows"))
            at = np.minimum(np.searchsorted(keys, hashes[a:b]), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == hashes[a:b])
            out[a + hit] = rows[codes[at[hit]]]
    return out, at_hash


def _discounted(count: np.ndarray, d: list[float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3).astype(np.int64)], 0.0)


def _context(total: np.ndarray, n1: np.ndarray, n2: np.ndarray, n3: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """What discounted counts are divided by, and the weight of the lower order (which is left alone where the context has no count)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        gamma = (d[0] * n1 + d[1] * n2 + d[2] * n3) / total
    return np.where(total > 0, total, np.inf), np.where(total > 0, gamma, 1.0)


_SCORES = "doc_id long, train_tokens long, n_tokens long, n_known long, base_score double, score double"


def _scores(model):
    """A mapInArrow function: texts (text, train, doc_id) to their sums."""

    def token_scores(m: Model, w, vw, uvw, first, train) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each token, whether training has it, and its log10 base probability.

        What depends on one n-gram only is worked out once for each distinct one.
        """
        uni, at = lookup(m.tables["uni"], len(UNI), np.r_[w, _START])
        w, v = at[:-1], np.r_[at[:1], at[:-2]]
        v[first] = at[-1]
        if m.t1:
            p1 = _discounted(uni[:, 1], m.d1) / m.t1 + m.g1 / (m.vocabulary + 1)
        else:
            p1 = np.full(len(uni), 1.0 / (m.vocabulary + 1))
        total, gamma = _context(*uni[:, 2:].T.astype(float), m.d2)
        known, base = (uni[:, 0] > 0)[w], np.log10((uni[:, 0] + 1) / float(m.total + m.vocabulary + 1))[w]
        p, total, gamma = p1[w], total[v], gamma[v]

        bi, at = lookup(m.tables["bi"], len(BI), np.r_[vw, _STARTS])
        # Not stored, yet in a training text: met there and nowhere else.
        bi = np.r_[bi, [[1, 1, 1, 1, 0, 0]]]
        vw = np.where(train & (bi[:, 0] == 0)[at[:-1]], len(bi) - 1, at[:-1])
        uv = np.r_[vw[:1], vw[:-1]]
        uv[first] = at[-1]
        p = _discounted(bi[:, 1], m.d2)[vw] / total + gamma * p
        total, gamma = _context(*bi[:, 2:].T.astype(float), m.d3)
        total, gamma = total[uv], gamma[uv]

        tri, at = lookup(m.tables["tri"], len(TRI), uvw)
        top = np.where(train & (tri[:, 0] == 0)[at], _discounted(np.ones(1), m.d3), _discounted(tri[:, 0], m.d3)[at])
        return np.log10(top / total + gamma * p), known, base

    def summed(m: Model, ids: list[int | None], held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        n = len(ids)
        owner, *columns = _joined(held)
        logp, known, base = token_scores(m, *columns)
        rows = {
            "doc_id": pa.array(ids, pa.int64()),
            "train_tokens": np.full(n, m.total),
            "n_tokens": np.bincount(owner, minlength=n),
            "n_known": np.bincount(owner[known], minlength=n),
            "base_score": np.bincount(owner, base, n),
            "score": np.bincount(owner, logp, n),
        }
        return pa.RecordBatch.from_pydict(rows)

    def run(batches):
        m, hasher = model.value, Hasher()
        ids, held, n, tokens = [], [], 0, 0
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, texts in blocks(batch.column(0)):
                f = grams(hasher, texts)
                ids += batch.column(2).slice(first, len(texts)).to_pylist()  # a slice would hold the whole batch
                held.append((f.owner + n, f.w, f.vw, f.uvw, f.first, train[first : first + len(texts)][f.owner]))
                n, tokens = n + len(texts), tokens + len(f.w)
                if tokens >= SCORE_AT_ONCE:
                    yield summed(m, ids, held)
                    ids, held, n, tokens = [], [], 0, 0
        if held:
            yield summed(m, ids, held)

    return run


def scored(spark, docs: DataFrame, train: Column) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, train_tokens, n_tokens, n_known, base_score, score.

    The model is fitted on the rows where ``train`` holds; it serves these rows of ``docs`` only.
    Each text is scored and summed in the task that reads it.
    """
    docs = docs.select("text", F.coalesce(train, F.lit(False)).alias("train"), F.col("doc_id").cast("long").alias("doc_id"))
    model = spark.sparkContext.broadcast(fit(spark, docs.select("text", "train")))
    return docs.mapInArrow(_scores(model), _SCORES)
