"""N-best segmentation and decoding with a public SentencePiece model (pieces and their scores).

A text is ``" " + text`` as a lattice: an arc for every piece that occurs, with the piece's score,
and for a character without a piece an arc of its UTF-8 byte pieces. Segmentation is by best sum
of scores. N-best: forward Viterbi scores are exact heuristics for an A-star search that runs
backward from the end, so paths leave the queue in order of their scores.

No piece goes on after white space has begun within it, so the lattice falls apart at words:
forward and backward Viterbi run over all new distinct words of a batch at once, and give each word's best
path and the loss of its second best. Among the N best of a text only the N - 1 words of
least loss can differ from their best path; A-star runs over their lattices and then over the lattice of their
alternatives. Alternatives are kept as edits against the best segmentation.

Decoding is exact for every text, U+2581 included. Defined results: a null or empty text is the
single space piece (or its bytes) and decodes to the empty text; ties go to the longer, earlier piece;
repeated rows repeat; an empty table gives none.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from statmart.llm.common import Memo, PieceTable, batches, groups_of, ragged

N_BEST = 4
SCHEMA = ("doc_id long, n_chars long, n_pieces long, score double, ids array<int>, "
          "alternatives array<struct<score: double, edits: array<struct<start: int, length: int, ids: array<int>>>>>, "
          "round_trip boolean")
_UNITS = re.compile(r" *[^ \n]+| +|\n")


def n_best_paths(arcs: list[list[tuple]], n: int) -> list[tuple[float, tuple]]:
    """The n best (score, labels) of a lattice; ``arcs[end]`` lists (start, score, label)."""
    best = [0.0] + [-float("inf")] * (len(arcs) - 1)
    for end in range(1, len(arcs)):
        for start, score, _ in arcs[end]:
            best[end] = max(best[end], best[start] + score)
    queue = [(-best[-1], len(arcs) - 1, (), 0.0)]
    found: list[tuple[float, tuple]] = []
    while queue and len(found) < n:
        _, place, labels, behind = heapq.heappop(queue)
        if place == 0:
            found.append((behind, labels))
            continue
        for start, score, label in arcs[place]:
            heapq.heappush(queue, (-(best[start] + score + behind), start, (label, *labels), score + behind))
    return found


class PieceModel:
    """A model's pieces as a trie over code points, with batch Viterbi over words."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of = [b""] * size
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.scores = np.array([model.get_score(i) for i in range(size)])
        children: dict[tuple[int, int], int] = {}
        pieces = [-1]
        for i in range(size):
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
                continue
            plain = piece.replace("▁", " ")
            if "\n" in plain or re.search("[^ ] ", plain):
                raise ValueError("a piece of this model crosses the start of a word")
            self.bytes_of[i] = plain.encode()
            node = 0
            for c in plain:
                node = children.setdefault((node, ord(c)), len(pieces))
                if node == len(pieces):
                    pieces.append(-1)
            pieces[node] = i
        self.piece_at = np.array(pieces, dtype=np.int64)
        self.children = children
        self._index(np.array([a << 21 | b for a, b in children], dtype=np.int64), np.array(list(children.values()), dtype=np.int64))
        self.longest = max(len(b.decode()) for b in self.bytes_of if b and b[0] < 128 or len(b) > 1)
        self.unknown = float(self.scores.min()) - 10.0
        self.piece_lengths = np.array([len(b) for b in self.bytes_of], dtype=np.int64)
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)

    def _index(self, keys: np.ndarray, targets: np.ndarray):
        """Arcs of the trie: those of its root by code point, all by (node, code point) in an open hash table."""
        root = keys < 1 << 21
        self.first = np.zeros(int(keys[root].max(initial=0)) + 2, dtype=np.int64)  # the last stands for all beyond
        self.first[keys[root]] = targets[root]
        bits = max(3, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys, self.slot_targets = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        left, at = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = self.slot_keys[at] < 0
            self.slot_keys[at[free]] = keys[left[free]]
            placed = self.slot_keys[at] == keys[left]
            self.slot_targets[at[placed]] = targets[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _step(self, nodes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = nodes << 21 | codes
        at = self._slots(keys)
        found = self.slot_keys.take(at)
        hit = found == keys
        other = np.flatnonzero(~hit & (found >= 0))
        while len(other):
            at[other] = (at[other] + 1) & self.mask
            found = self.slot_keys[at[other]]
            same = found == keys[other]
            hit[other[same]] = True
            other = other[~same & (found >= 0)]
        return self.slot_targets.take(at), hit

    def _same_length(self, words: list[str]):
        """(pieces by place or 0 lengths, scores, losses) of words that have one length."""
        count, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(count, size)
        codes = np.ascontiguousarray(codes.T).astype(np.int64)
        forward = np.full((size + 1, count), -np.inf)
        forward[0] = 0.0
        came, by = np.zeros((size + 1, count), dtype=np.int16), np.zeros((size + 1, count), dtype=np.int32)
        arcs = []

        def relax(rows, i, length, pieces, scores):
            total = forward[i].take(rows) + scores
            end = forward[i + length]
            better = np.flatnonzero(total > end.take(rows))
            won = rows.take(better)
            end[won] = total.take(better)
            came[i + length][won], by[i + length][won] = length, pieces.take(better)
            arcs.append((rows, i, length, scores))

        for i in range(size):
            known = np.zeros(count, dtype=bool)
            nodes = self.first.take(codes[i], mode="clip")
            rows = np.flatnonzero(nodes)
            nodes = nodes.take(rows)
            for length in range(1, min(self.longest, size - i) + 1):
                if not len(rows):
                    break
                pieces = self.piece_at.take(nodes)
                good = np.flatnonzero(pieces >= 0)
                if len(good):
                    pieces, having = pieces.take(good), rows.take(good)
                    relax(having, i, length, pieces, self.scores.take(pieces))
                    if length == 1:
                        known[having] = True
                if i + length < size:
                    nodes, hit = self._step(nodes, codes[i + length].take(rows))
                    hit = np.flatnonzero(hit)
                    rows, nodes = rows.take(hit), nodes.take(hit)
            rest = np.flatnonzero(~known)
            if len(rest):
                relax(rest, i, 1, -1 - codes[i].take(rest), np.full(len(rest), self.unknown))
        chosen = np.zeros((size, count), dtype=np.int16)  # length of the best path's piece at each start
        labels = np.zeros((size, count), dtype=np.int32)
        place, rows = np.full(count, size), np.arange(count)
        while len(rows):
            at = place[rows]
            length = came[at, rows]
            chosen[at - length, rows], labels[at - length, rows] = length, by[at, rows]
            place[rows] = at - length
            rows = rows[place[rows] > 0]
        backward = np.full((size + 1, count), -np.inf)
        backward[size] = 0.0
        loss = np.full(count, np.inf)
        for rows, i, length, scores in reversed(arcs):
            ahead = scores + backward[i + length].take(rows)
            start = backward[i]
            start[rows] = np.maximum(start.take(rows), ahead)
            off = np.flatnonzero(chosen[i].take(rows) != length)
            if len(off):
                rows = rows.take(off)
                loss[rows] = np.minimum(loss.take(rows), forward[size].take(rows) - forward[i].take(rows) - ahead.take(off))
        on = chosen.T > 0
        return labels.T[on], on.sum(axis=1), forward[size], loss

    def best_of_words(self, words: list[str]):
        """(ids, lengths, scores, losses): best segmentation of each word, concatenated."""
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        labels, counts, scores, losses = [], [], [], []
        starts = np.flatnonzero(np.diff(sizes[order], prepend=-1))
        for first, last in zip(starts, [*starts[1:], len(order)]):
            for at in range(first, last, 20_000):
                part = [words[k] for k in order[at:min(last, at + 20_000)]]
                for out, value in zip((labels, counts, scores, losses), self._same_length(part)):
                    out.append(value)
        flat, count = self._with_bytes(np.concatenate(labels), np.concatenate(counts))
        # back to the order of the words
        back = np.argsort(order)
        ends = np.cumsum(count)
        new = count[back]
        shift = np.repeat((ends - count)[back] - (np.cumsum(new) - new), new)
        return flat[np.arange(len(flat)) + shift], new, np.concatenate(scores)[back], np.concatenate(losses)[back]

    def _with_bytes(self, labels: np.ndarray, counts: np.ndarray):
        """Replace labels of characters without a piece (-1 - code point) by their byte pieces."""
        if not (labels < 0).any():
            return labels.astype(np.int32), counts
        bytes_of = {c: self._bytes_ids(c) for c in np.unique(labels[labels < 0]).tolist()}
        sizes = np.ones(len(labels), dtype=np.int64)
        for c, ids in bytes_of.items():
            sizes[labels == c] = len(ids)
        out = np.repeat(labels, sizes)
        starts = np.cumsum(sizes) - sizes
        for c, ids in bytes_of.items():
            at = starts[labels == c]
            for j, x in enumerate(ids):
                out[at + j] = x
        word = np.repeat(np.arange(len(counts)), counts)
        return out.astype(np.int32), np.bincount(word, weights=sizes, minlength=len(counts)).astype(np.int64)

    def _bytes_ids(self, label: int) -> list[int]:
        return [int(self.byte_ids[x]) for x in chr(-1 - label).encode("utf-8", "surrogatepass")]

    def n_best_of_word(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best (score, ids) of one word, by A-star over its lattice."""
        arcs: list[list[tuple]] = [[] for _ in range(len(word) + 1)]
        for i in range(len(word)):
            node, known = 0, False
            for j in range(i, len(word)):
                node = self.children.get((node, ord(word[j])))
                if node is None:
                    break
                if self.piece_at[node] >= 0:
                    known |= j == i
                    arcs[j + 1].append((i, float(self.scores[self.piece_at[node]]), int(self.piece_at[node])))
            if not known:
                arcs[i + 1].append((i, self.unknown, -1 - ord(word[i])))
        return [(score, [x for label in labels for x in ([label] if label >= 0 else self._bytes_ids(label))])
                for score, labels in n_best_paths(arcs, n)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a sequence of ids, as UTF-8."""
        lengths = self.piece_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.piece_starts[ids] - (ends - lengths), lengths)
        return self.piece_bytes[places].tobytes()[1:]


def least_losses(losses: np.ndarray, n: int) -> np.ndarray:
    """Places of the n least finite losses (ties: the first), in order of place."""
    if len(losses) > n:
        bound = np.partition(losses, n - 1)[n - 1] if n else -np.inf
        below, equal = np.flatnonzero(losses < bound), np.flatnonzero(losses == bound)
        places = np.sort(np.concatenate([below, equal[:n - len(below)]]))
    else:
        places = np.arange(len(losses))
    return places[np.isfinite(losses[places])]


def encode(docs: DataFrame, n_best: int = N_BEST, model_path: str | None = None) -> DataFrame:
    """(doc_id, n_chars, n_pieces, score, ids, alternatives, round_trip) of every row of ``docs``.

    ``alternatives`` are the next best segmentations in order (at most ``n_best - 1``), each as
    edits (``length`` ids from ``start`` on are replaced by ``ids``) against the best.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    edit = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
    edits_type = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def work():
        model = PieceModel(path)
        words = PieceTable(model.best_of_words, limit=400_000)
        memo = Memo(lambda word: model.n_best_of_word(word, n_best))

        def one(text, units, codes):
            lengths, scores = words.lengths[codes], words.extra[0][codes]
            ids = words.gather(codes)
            best = float(scores.sum())
            open_places = least_losses(words.extra[1][codes], n_best - 1)
            options = [memo[units[p]] for p in open_places]
            arcs = [[]] + [[(k, score - option[0][0], j) for j, (score, _) in enumerate(option)] for k, option in enumerate(options)]
            starts = np.cumsum(lengths) - lengths
            alternatives = []
            for delta, ranks in n_best_paths(arcs, n_best)[1:]:
                edits = [{"start": int(starts[p]), "length": int(lengths[p]), "ids": option[rank][1]}
                         for p, option, rank in zip(open_places, options, ranks) if rank]
                alternatives.append({"score": best + delta, "edits": edits})
            return ids, best, alternatives, model.decode(ids) == text.encode("utf-8", "surrogatepass")

        def run(batch):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            made = []
            for first, last in groups_of(texts, 1 << 20):
                split = [_UNITS.findall(" " + x) for x in texts[first:last]]
                codes = words.codes([u for x in split for u in x])
                at = 0
                for text, units in zip(texts[first:last], split):
                    made.append(one(text, units, codes[at:at + len(units)]))
                    at += len(units)
            counts = np.array([len(x[0]) for x in made], dtype=np.int64)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in texts], type=pa.int64()), pa.array(counts, type=pa.int64()),
                       pa.array([x[1] for x in made], type=pa.float64()), ragged(np.concatenate([x[0] for x in made]), counts, pa.int32()),
                       pa.array([x[2] for x in made], type=edits_type), pa.array([x[3] for x in made])]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "n_pieces", "score", "ids", "alternatives", "round_trip"])

        return run

    return batches(docs.select("doc_id", "text"), work, SCHEMA)


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def work():
        model = PieceModel(path)

        def run(batch):
            texts = [model.decode(np.array(x or [], dtype=np.int64)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, type=pa.string())], ["doc_id", "text"])

        return run

    return batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string")
