"""Removal of repeated byte strings by deep-shallow suffix sorting.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in its own text or
another. Strings that start at neighbouring bytes are suffixes cut at LENGTH bytes; sorting them
brings equal ones together. The sort is deep-shallow: multikey quicksort (three-way partition at a
pivot, eight bytes at a time) to a shallow depth, then a blind trie orders each group whose suffixes
agree so far.

How it is dealt out: equal strings have equal *marks*, the least hash of their GRAM-byte substrings,
so suffixes are dealt by mark. Neighbouring suffixes mostly share a mark and travel as one *run* of
bytes. Before any bytes move, marks that occur once in all texts are left out (nothing equal can
exist), equal texts and equal runs are one with a weight, and only a first copy of each distinct run
is sorted; what the sort finds is then joined back to every place of the run.

Hot groups: counting combines before each shuffle; joins on marks are skew joins; a mark whose
distinct runs hold more than GROUP suffixes is dealt anew by hashes of whole suffixes, by which only
equal suffixes meet, one copy of each. So no sort holds more than GROUP suffixes of one mark.

Defined results: a null text is empty; texts shorter than LENGTH bytes keep all; repeated rows are
repeats of each other (a text that comes twice and has LENGTH bytes goes whole, in both rows); null
or repeated doc_ids are returned as they are; extra columns are not read; an empty table gives an
empty result. Texts of any length are taken whole, in overlapping chunks.

Hashes: texts are told apart by 128 bits of SHA-256, runs by a 64-bit mark and 64 bits over their
bytes; suffixes of different runs are compared byte by byte.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statmart.llm.common import batches, map_batches, partitions
from statmart.session import materialize, scratch_path

#: Bytes of a repeated string; bytes of the substrings whose hashes deal suffixes out.
LENGTH, GRAM = 200, 50
#: Most suffixes of a run (ten bits of ``pos``), and of a mark that are sorted together.
RUN, GROUP = 512, 1 << 17
#: Bytes of the text that are hashed at once; suffixes that are sorted in one go (whole marks).
CHUNK, SORTED = 1 << 20, 1 << 19
#: Depth in bytes at which multikey quicksort hands over to blind tries.
SHALLOW = 32

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that they have inverses modulo 2 ** 64
_RUNS = "mark long, run long, hi long, lo long, pos long"
_PIECE = ["mark", "run", "weight", "piece"]


# --- runs of suffixes that share a mark ---------------------------------------------------------

class Hasher:
    """64-bit hashes of all substrings of one length, from prefix sums of a polynomial modulo 2 ** 64."""

    def __init__(self, base: int, seed: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.values = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            self.up, self.down = (self._powers(b, len(data) + 1) for b in (self.base, self.inverse))
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[data] * self.up[:len(data)], out=out[1:])
        return out

    def between(self, prefixes: np.ndarray, first, end) -> np.ndarray:
        """Mixed hashes of the substrings [first, end), given as slices or index arrays."""
        h = (prefixes[end] - prefixes[first]) * (self.down[first] if not isinstance(first, slice) else self.down[:len(prefixes)][first])
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` neighbouring values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = len(values) - width + 1
    return pick(out[:rest], out[width - have:width - have + rest]) if have < width else out


class Runs:
    """Runs of the suffixes of texts: neighbours of one mark, RUN at most."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram = length, gram
        self.marks, self.contents = Hasher(_BASES[0], 11), Hasher(_BASES[1], 12)

    def of(self, data: np.ndarray, owner: np.ndarray):
        """(text, first byte, suffixes, mark, hash of the run's bytes, mark comes twice in it) of each
        run of ``data``, the bytes of texts in a row. ``owner`` is the text of each byte; a suffix
        needs ``length`` bytes of one text."""
        last = len(data) - self.length + 1
        if last < 1:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
        width = self.length - self.gram + 1
        sums = self.marks.prefixes(data)
        grams = self.marks.between(sums, slice(0, len(data) - self.gram + 1), slice(self.gram, None))
        least = sliding(grams, width, np.minimum)
        good = owner[:last] == owner[self.length - 1:]
        new = np.ones(last, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | ~good[:-1] | (owner[1:last] != owner[:last - 1])
        starts = np.flatnonzero(new & good)
        # a run ends where the next one or a text's last bytes begin
        stops = np.flatnonzero(np.append(new | ~good, True))
        counts = stops[np.searchsorted(stops, starts, side="right")] - starts
        pieces = -(-counts // RUN)
        first = np.repeat(starts, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        counts = np.minimum(np.repeat(starts + counts, pieces) - first, RUN)
        keys = least[first]
        content = self.contents.between(self.contents.prefixes(data), first, first + counts + self.length - 1)
        # places of least grams: those that equal the largest of the leasts of the suffixes around them
        padded = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
        places = np.flatnonzero(sliding(padded, width, np.maximum) == grams)
        low, high = np.searchsorted(places, first), np.searchsorted(places, first + counts + width - 1)
        many = high - low
        flat = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        run_of = np.repeat(np.arange(len(first)), many)
        twice = np.bincount(run_of, weights=grams[places[flat]] == keys[run_of], minlength=len(first)) > 1
        return owner[first], first, counts, keys.view(np.int64), content.view(np.int64), twice


def chunks(raws: list[bytes], length: int):
    """Lists of (text's number, first byte, bytes), about CHUNK bytes at a time. Longer texts come in
    chunks that overlap by ``length`` - 1 bytes, so each suffix lies in one of them."""
    held, size = [], 0
    for i, raw in enumerate(raws):
        for at in range(0, max(1, len(raw) - length + 1), CHUNK):
            part = raw[at:at + CHUNK + length - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def runs_of(units: DataFrame, length: int, gram: int) -> DataFrame:
    """(mark, run, hi, lo, pos) of the runs of ``units``; pos packs the first byte, the number of
    suffixes (10 bits), whether the mark comes twice, and whether the text does."""

    def work():
        finder = Runs(length, gram)

        def run(batch):
            raws = batch.column("text").to_pylist()
            hi, lo = batch.column("hi").to_numpy(), batch.column("lo").to_numpy()
            copied = (batch.column("copies").to_numpy() > 1).astype(np.int64)
            out = []
            for held in chunks(raws, length):
                texts, places, parts = zip(*held)
                sizes = np.array([len(p) for p in parts])
                data = np.frombuffer(b"".join(parts), dtype=np.uint8)
                piece = np.repeat(np.arange(len(parts)), sizes)
                own, first, counts, keys, content, twice = finder.of(data, piece)
                begin = np.array(places, dtype=np.int64) - (np.cumsum(sizes) - sizes)
                text = np.array(texts, dtype=np.int64)[own]
                pos = ((first + begin[own]) << 12) | (counts << 2) | (twice.astype(np.int64) << 1) | copied[text]
                out.append((keys, content, hi[text], lo[text], pos))
            columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 5
            return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in columns], ["mark", "run", "hi", "lo", "pos"])

        return run

    return batches(units.select("hi", "lo", "copies", "text"), work, _RUNS)


# --- deep-shallow sort --------------------------------------------------------------------------

def shallow_sort(words: np.ndarray, places: np.ndarray, groups: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the suffixes at ``places`` to ``depth`` bytes, for all groups (row
    counts of neighbours) side by side. ``words[i]`` holds the eight bytes from i on. Returns the
    order and, for each row of it, whether it agrees with the row before to ``depth`` bytes."""
    n = len(places)
    order, same = np.arange(n), np.zeros(n, dtype=bool)
    begin, size = np.cumsum(groups) - groups, np.asarray(groups, dtype=np.int64)
    deep = np.zeros(len(size), dtype=np.int64)
    while True:
        done = (deep >= depth) & (size > 1)
        if done.any():  # all but the first row of a group agree with the row before
            b, s = begin[done], size[done]
            at = np.repeat(b, s) + np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            same[at] = True
            same[b] = False
        keep = (deep < depth) & (size > 1)
        begin, size, deep = begin[keep], size[keep], deep[keep]
        if not len(size):
            return order, same
        ends = np.cumsum(size)
        offsets = ends - size
        segment = np.repeat(np.arange(len(size)), size)
        slots = np.arange(ends[-1]) + np.repeat(begin - offsets, size)
        rows = order[slots]
        chars = words[places[rows] + np.repeat(deep, size)]
        a, b, c = chars[offsets], chars[offsets + size // 2], chars[ends - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[segment]
        kind = (chars >= pivot).astype(np.int64) + (chars > pivot)
        counts = np.bincount(segment * 3 + kind, minlength=3 * len(size))
        # stable within each (group, kind): a running number of each kind, less that before the group
        target = np.empty(len(rows), dtype=np.int64)
        starts3 = np.cumsum(counts) - counts
        for k in range(3):
            own = np.flatnonzero(kind == k)
            per = counts[k::3]
            target[own] = np.arange(len(own)) + np.repeat(starts3[k::3] - (np.cumsum(per) - per), per)
        order[slots[target]] = rows  # slots grow with the place among active rows
        begin = np.repeat(begin, 3) + starts3 - np.repeat(offsets, 3)
        size, deep = counts, np.repeat(deep, 3)
        deep[1::3] += 8


class BlindTrie:
    """A trie that holds, at inner nodes, only the depth of the first byte that differs. A new string
    goes down by single bytes, is compared once with the leaf it reaches, and splits the path there."""

    __slots__ = ("root", "size")

    def __init__(self, size: int):
        self.root, self.size = None, size

    def add(self, text: bytes, row: int) -> None:
        number = int.from_bytes(text, "big")
        if self.root is None:
            self.root = (number, [row])
            return
        node, size = self.root, self.size
        while type(node) is list:  # [depth, {byte: node}]
            children = node[1]
            node = children.get(text[node[0]]) or next(iter(children.values()))
        differ = number ^ node[0]
        if not differ:
            node[1].append(row)
            return
        agree = size - (differ.bit_length() + 7) // 8
        other = (node[0] >> (8 * (size - 1 - agree))) & 255
        above, node = None, self.root
        while type(node) is list and node[0] < agree:
            above, node = node, node[1][text[node[0]]]
        if type(node) is list and node[0] == agree:
            node[1][text[agree]] = (number, [row])
            return
        inner = [agree, {other: node, text[agree]: (number, [row])}]
        if above is None:
            self.root = inner
        else:
            above[1][text[above[0]]] = inner

    def classes(self):
        """Lists of rows with equal strings, in the strings' order."""
        open_nodes = [self.root] if self.root is not None else []
        while open_nodes:
            node = open_nodes.pop()
            if type(node) is list:
                open_nodes += [child for _, child in sorted(node[1].items(), reverse=True)]
            else:
                yield node[1]


def deep_shallow(data: bytes, places: np.ndarray, groups: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class) of the suffixes at ``places`` of ``data``, sorted by their first ``length`` bytes
    within each group; neighbours of one class number agree in all of them."""
    padded = np.frombuffer(data + bytes(8), dtype=np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(">u8").reshape(-1).astype(np.uint64)
    depth = min(SHALLOW, length) // 8 * 8
    order, same = shallow_sort(words, places, groups, depth)
    new = ~same
    if depth < length:
        starts = np.flatnonzero(~same)
        sizes = np.diff(np.append(starts, len(same)))
        for s, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            rows, trie = order[s:s + n].tolist(), BlindTrie(length - depth)
            for row, place in zip(rows, places[order[s:s + n]].tolist()):
                trie.add(data[place + depth:place + length], row)
            at = s
            for members in trie.classes():
                order[at:at + len(members)] = members
                new[at] = True
                new[at + 1:at + len(members)] = False
                at += len(members)
    return order, np.cumsum(new) - 1


def repeated_suffixes(pieces: DataFrame, length: int) -> DataFrame:
    """(mark, run, first, last): places within a run, ends included, of suffixes that come more than
    once among ``pieces`` (mark, run, weight, piece). The pieces of a mark lie in a row in one task."""

    def find(marks, runs, weights, raws):
        counts = np.array([len(x) - length + 1 for x in raws], dtype=np.int64)
        owner = np.repeat(np.arange(len(raws)), counts)
        sizes = np.array([len(x) for x in raws], dtype=np.int64)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
        edges = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
        order, classes = deep_shallow(b"".join(raws), places, np.add.reduceat(counts, edges), length)
        total = np.bincount(classes, weights=weights[owner[order]])
        again = np.zeros(len(places), dtype=bool)
        again[order] = total[classes] > 1
        begin = np.flatnonzero(again & np.append(True, ~again[:-1] | (owner[1:] != owner[:-1])))
        end = np.flatnonzero(again & np.append(~again[1:] | (owner[1:] != owner[:-1]), True))
        own = owner[begin]
        return pa.RecordBatch.from_arrays([pa.array(marks[own]), pa.array(runs[own]), pa.array(offset[begin], type=pa.int64()), pa.array(offset[end], type=pa.int64())],
                                          ["mark", "run", "first", "last"])

    def sort(stream):
        held, size = [[], [], [], []], 0
        for batch in stream:
            columns = [batch.column(c).to_numpy() for c in ("mark", "run", "weight")] + [batch.column("piece").to_pylist()]
            edges = np.flatnonzero(np.append(columns[0][1:] != columns[0][:-1], False)) + 1
            for first, last in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if size >= SORTED and held[0][-1][-1] != columns[0][first]:
                    yield find(*(np.concatenate(x) for x in held[:3]), held[3])
                    held, size = [[], [], [], []], 0
                for x, y in zip(held, columns):
                    x.append(y[first:last]) if x is not held[3] else x.extend(y[first:last])
                size += sum(map(len, columns[3][first:last])) - (length - 1) * (last - first)
        if held[0]:
            yield find(*(np.concatenate(x) for x in held[:3]), held[3])

    dealt = pieces.select(*_PIECE).repartition(partitions(pieces.sparkSession), "mark").sortWithinPartitions("mark", "run")
    return map_batches(dealt, sort, "mark long, run long, first long, last long")


# --- dealing ------------------------------------------------------------------------------------

def _suffixes():
    return F.shiftright("pos", 2).bitwiseAND(F.lit(1023).cast("long"))


def _copied():
    return F.col("pos").bitwiseAND(F.lit(1).cast("long"))


def live(runs: DataFrame) -> DataFrame:
    """Runs whose mark comes more than once: in several places, in a copied text, or twice in a run."""
    twice = F.shiftright("pos", 1).bitwiseAND(F.lit(1).cast("long"))
    often = runs.groupBy("mark").agg(F.sum(1 + _copied() + twice).alias("n")).where("n > 1")
    # written first: the join can then split a hot mark, which it can't right above an aggregate
    return runs.join(materialize(often.select("mark"), "suffix-marks"), "mark", "left_semi")


def distinct_runs(places: DataFrame) -> DataFrame:
    """One row for each distinct run: its weight (places, copied texts twice) and first place."""
    return (places.groupBy("mark", "run")
            .agg(F.sum(1 + _copied()).alias("weight"), F.min(F.struct("hi", "lo", "pos")).alias("at"))
            .select("mark", "run", "weight", "at.hi", "at.lo", "at.pos"))


def pieces_of(units: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """The bytes of each distinct run, cut from its text within the join."""
    first, size = F.shiftright("pos", 12).cast("int") + 1, (_suffixes() + length - 1).cast("int")
    return units.join(runs, ["hi", "lo"]).select("mark", "run", "weight", "hi", "lo", "pos", F.col("text").substr(first, size).alias("piece"))


def whole_suffixes(pieces: DataFrame, length: int) -> DataFrame:
    """Runs of one suffix each, marked by a hash of all its bytes, with the run they belong to."""

    def work():
        marks, contents = Hasher(_BASES[0], 21), Hasher(_BASES[1], 22)

        def run(batch):
            raws = batch.column("piece").to_pylist()
            counts = np.array([len(x) - length + 1 for x in raws], dtype=np.int64)
            sizes = np.array([len(x) for x in raws], dtype=np.int64)
            owner = np.repeat(np.arange(len(raws)), counts)
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            first = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
            data = np.frombuffer(b"".join(raws), dtype=np.uint8)
            keys, content = (h.between(h.prefixes(data), first, first + length).view(np.int64) for h in (marks, contents))
            mark, name, weight, hi, lo, pos = (batch.column(c).to_numpy()[owner] for c in ("mark", "run", "weight", "hi", "lo", "pos"))
            pos = (((pos >> 12) + offset) << 12) | (1 << 2) | (weight > 1)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, content, hi, lo, pos, mark, name, offset)],
                                              ["mark", "run", "hi", "lo", "pos", "of_mark", "of_run", "offset"])

        return run

    return batches(pieces, work, _RUNS + ", of_mark long, of_run long, offset long")


def repeats_of_runs(units: DataFrame, places: DataFrame, length: int, group: int) -> DataFrame:
    """(mark, run, first, last) over all live runs, hot marks by whole suffixes."""
    runs = materialize(distinct_runs(places), "suffix-runs")
    sizes = runs.groupBy("mark").agg(F.sum(_suffixes()).alias("n")).where(F.col("n") > group)
    hot = materialize(sizes.select("mark"), "suffix-hot")
    if hot.isEmpty():
        return repeated_suffixes(pieces_of(units, runs, length), length)
    found = repeated_suffixes(pieces_of(units, runs.join(hot, "mark", "left_anti"), length), length)
    single = whole_suffixes(pieces_of(units, runs.join(hot, "mark", "left_semi"), length), length)
    alike = materialize(live(single), "suffix-whole")
    again = repeated_suffixes(pieces_of(units, distinct_runs(alike), length), length)
    back = alike.join(again.select("mark", "run"), ["mark", "run"], "left_semi").select(F.col("of_mark").alias("mark"), F.col("of_run").alias("run"), "offset")
    beside = Window.partitionBy("mark", "run").orderBy("offset")  # at most RUN rows
    spans = back.withColumn("span", F.col("offset") - F.row_number().over(beside)).groupBy("mark", "run", "span")
    return found.unionByName(spans.agg(F.min("offset").alias("first"), F.max("offset").alias("last")).drop("span"))


def repeated_spans(units: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(hi, lo, spans): for each text of ``units`` with repeats, its [first, end) byte spans, unmerged."""
    places = materialize(live(runs_of(units, length, gram)), "suffix-places")
    found = materialize(repeats_of_runs(units, places, length, group), "suffix-repeats")
    start = F.shiftright("pos", 12)
    spans = places.join(found, ["mark", "run"]).select("hi", "lo", F.struct((start + F.col("first")).alias("first"), (start + F.col("last") + length).alias("end")).alias("span"))
    return spans.groupBy("hi", "lo").agg(F.array_agg("span").alias("spans"))  # at most a span a byte of one text


def _kept(raw: bytes, firsts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed spans, what is left) of a text."""
    change = np.zeros(len(raw) + 1, dtype=np.int64)
    np.add.at(change, firsts, 1)
    np.add.at(change, ends, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()


def text_units(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, str]:
    """Distinct texts of ``length`` bytes or more with their number of rows, as a table bucketed by
    its key (hi, lo), so that the joins with it move no text; and the table's name."""
    spark, name = docs.sparkSession, f"text_units_{uuid.uuid4().hex}"
    keyed = with_key(docs).select("hi", "lo", F.col("text").cast("binary").alias("text")).where(F.length("text") >= length)
    units = keyed.groupBy("hi", "lo").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    (units.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "text-units"))
     .bucketBy(partitions(spark), "hi", "lo").saveAsTable(name))
    return spark.table(name), name


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with text never null, its SHA-256 as hex and 128 bits of it as a key."""
    sha = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sha", F.sha2("text", 256))
    part = lambda first: F.conv(F.substring("sha", first, 16), 16, -10).cast("long")
    return sha.withColumns({"hi": part(1), "lo": part(17)})


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of ``docs`` (doc_id,
    text). ``kept`` holds the remaining bytes of texts that lost some and is null for the others."""
    units, name = text_units(docs, length)

    def work():
        def run(batch):
            raws, spans = batch.column("text").to_pylist(), batch.column("spans")
            out = []
            for raw, own in zip(raws, spans):
                firsts, ends = (own.values.field(k).to_numpy() for k in range(2))
                removed, runs, kept = _kept(raw, firsts, ends)
                out.append((removed, runs, hashlib.sha256(kept).hexdigest(), kept))
            removed, runs, sha, kept = (list(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([batch.column("hi"), batch.column("lo"), pa.array(removed, type=pa.int64()), pa.array(runs, type=pa.int64()), pa.array(sha), pa.array(kept, type=pa.binary())],
                                              ["hi", "lo", "n_removed", "n_spans", "kept_sha256", "kept"])

        return run

    changed = batches(units.join(repeated_spans(units, length, gram, group), ["hi", "lo"]).select("hi", "lo", "text", "spans"), work,
                      "hi long, lo long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    found = materialize(changed, "suffix-kept")
    docs.sparkSession.sql(f"DROP TABLE {name}")  # its files stay in the scratch folder
    rows = with_key(docs).select("doc_id", "hi", "lo", "sha", F.octet_length("text").cast("long").alias("n_bytes"))
    none = F.lit(0).cast("long")
    return rows.join(found, ["hi", "lo"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")
