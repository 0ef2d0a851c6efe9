"""Toxicity scores of texts restored from disguise by a noisy channel.

1. A character trigram model is counted over all documents.
2. A token that may be disguised (digits or signs among letters, letters repeated three times
   or more, single letters spread out by spaces or signs) becomes a lattice of characters:
   a sign may stand for letters it resembles, a repeated letter or a sign between letters may be
   dropped, each at a cost. Viterbi decoding under the trigram model picks the reading. Any other token has one reading.
   Where no word of the reading counts, signs at a token's ends are read as letters and doubled letters as single ones.
3. Features of a restored word are the word and its first four to six letters. A lexicon keeps all those
   that are much more frequent in toxic labelled texts, rare ones if that is hardly by chance; a logistic regression on the weights of
   the words found gives the score.

Lexicon and regression are fitted on about ``sample`` labelled documents at most, chosen by hash; only
their texts and ``toxic`` are used. Trigram counts and scores cover all documents.

Defined results: null and empty texts get the score of a text without findings; labels that
are null are ignored; several labels of one doc_id count as toxic if one is; without labels of both classes every score is 0;
repeated rows repeat; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import MEMO_ENTRIES, batches, groups_of, map_batches, sample_condition
from statmart.session import materialize

SAMPLE = 20_000
THRESHOLD = 0.3
#: A feature occurs in so many toxic texts at least; below a hundredth of them it must be as unlikely
#: by chance as RARE_CHANCE.
LEAST_SEEN, RARE_CHANCE = 4, 1e-3
LEAST_LOG_ODDS = 2.5
# fixed values: letters that signs resemble
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "€": "e", "£": "l", "¡": "i", "(": "c", "<": "c"}
SEPARATORS = "-._*'~^ "
#: Costs (nats) of reading a sign as a letter or, within a token, as the end of a word; of dropping
#: a repeated letter; of dropping a separator.
SIGN_COST, BREAK_COST, REPEAT_COST, SEPARATOR_COST = 0.5, 1.5, 0.5, 0.3

# Letters and classes of the trigram model: 0 boundary, 1-26 a to z, 27-58 U+00E0 to U+00FF,
# 59 other letters, 60 digits and signs that resemble letters.
CLASSES = 64
_CLASS = np.zeros(0x250, dtype=np.int64)
_CLASS[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CLASS[0xE0:0x100] = np.arange(27, 59)
_CLASS[0xC0:0xE0] = np.arange(27, 59)
_CLASS[0x100:0x250] = 59
for _sign in SIGNS:
    if ord(_sign) < len(_CLASS):
        _CLASS[ord(_sign)] = 60

_MARK = rf"(?:[^\W_]|[{re.escape(''.join(SIGNS))}])"
_RUN = re.compile(rf"(?<!\S){_MARK}(?:[\s\-._*~^]+{_MARK}){{2,}}(?!\S)")
_GAP = re.compile(r"[\s\-._*~^]+")
_DOUBLE = re.compile(r"([^\W\d_])\1+")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")
_SIGN_SET = frozenset(SIGNS)
#: What is stripped from a token's ends: signs that resemble no letter, and those that also end words.
ENDS = ".,;:?\"')[]{}#%&*=/\\-_~^>"
SIGN_ENDS = "(!<|+"
#: Every choice of doubled letters is tried up to so many; beyond, the lattice picks.
DOUBLES = 4


#: A run of spread letters is read in windows of twice this length that overlap by half.
RUN_PART = 128


def _parts(run: str) -> list[str]:
    """Overlapping windows over the whole of a run, so that a long one costs its length, not its square."""
    return [run[i:i + 2 * RUN_PART] for i in range(0, max(1, len(run) - RUN_PART), RUN_PART)]


def _spread(run: str) -> str | None:
    """A run of spread letters with one space at its narrowest gaps and two at wider ones; None if it
    holds no letter (four digits or more may still stand for some)."""
    if not any(c.isalpha() for c in run) and (len(_GAP.findall(run)) < 3 or not all(c.isdigit() for c in _GAP.sub("", run))):
        return None
    least = min(len(g) for g in _GAP.findall(run))
    return _GAP.sub(lambda g: " " if len(g.group()) == least else "  ", run)


def class_of(c: str) -> int:
    return int(_CLASS[ord(c)]) if ord(c) < len(_CLASS) else 59 if c.isalpha() else 0


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of class trigrams over all texts (at most CLASSES ** 3 rows reach the driver)."""

    def count(stream):
        total = np.zeros(CLASSES ** 3, dtype=np.int64)
        for batch in stream:
            raws = [x or "" for x in batch.column("text").to_pylist()]
            for first, last in groups_of(raws):
                codes = np.frombuffer("\n".join(raws[first:last]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                c = np.where(codes < len(_CLASS), _CLASS[np.minimum(codes, len(_CLASS) - 1)], 59)
                c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # runs of boundaries count once
                if len(c) > 2:
                    total += np.bincount(c[:-2] * CLASSES ** 2 + c[1:-1] * CLASSES + c[2:], minlength=CLASSES ** 3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["gram", "seen"])

    rows = map_batches(docs.select("text"), count, "gram long, seen long").groupBy("gram").agg(F.sum("seen").alias("seen")).toPandas()
    total = np.zeros(CLASSES ** 3)
    total[rows["gram"].to_numpy(dtype=np.int64)] = rows["seen"].to_numpy(dtype=np.float64)
    return total


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log P(third class | first two), interpolated with the bigram and a uniform class."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(axis=0)
    bigram = (two + 1.0) / (two.sum(axis=1, keepdims=True) + CLASSES)
    context = three.sum(axis=2, keepdims=True)
    return np.log((three + 8.0 * bigram[None, :, :]) / (context + 8.0))


class Restorer:
    """Reads disguised tokens under a character model."""

    def __init__(self, logs: np.ndarray):
        self.logs = logs.tolist()

    def suspicious(self, token: str) -> bool:
        if token.isalpha():
            return bool(_TRIPLE.search(token))
        letters = sum(c.isalpha() for c in token)
        return letters > 0 and (not _SIGN_SET.isdisjoint(token) or bool(_TRIPLE.search(token))
                                or (letters > 2 and any(c in token for c in SEPARATORS)))

    def decode(self, token: str, forced: frozenset = frozenset()) -> str:
        """The likeliest reading: words of letters, separated by single spaces; the signs at the places
        ``forced`` are letters."""
        # states: (last two classes, last letter) -> (cost, reading); their letters are readings of the last
        # three signs that were not left out, so a run of such signs adds states and length does not
        states = {(0, 0, ""): (0.0, "")}
        for i, c in enumerate(token + " "):
            options: list[tuple[str, float]] = []
            if c.isalpha():
                options.append((c, 0.0))
            else:
                if i not in forced:
                    options.append((" ", BREAK_COST if c in SIGNS and 0 < i < len(token) - 1 else 0.0))
                options += [(x, SIGN_COST) for x in SIGNS.get(c, "")]
            inner = 0 < i < len(token)
            drop = None
            if inner and c.isalpha() and token[i - 1] == c:
                drop = REPEAT_COST
            elif inner and c in SEPARATORS:
                drop = SEPARATOR_COST
            elif inner and token[i - 1] == c and c in SIGNS:
                drop = REPEAT_COST
            after: dict[tuple, tuple[float, str]] = {}
            for (a, b, last), (cost, text) in states.items():
                if drop is not None:
                    key, value = (a, b, last), (cost + drop, text)
                    if key not in after or value < after[key]:
                        after[key] = value
                for x, extra in options:
                    k = 0 if x == " " else class_of(x)
                    if x == " " and b == 0:
                        key, value = (a, b, ""), (cost + extra, text)
                    else:
                        key, value = (b, k, x), (cost + extra - self.logs[a][b][k], text + x)
                    if key not in after or value < after[key]:
                        after[key] = value
            states = after
        return min(states.values())[1].strip()

    def long_words(self, token: str) -> list[str]:
        """The reading of a token of any length; a long one is read in overlapping windows, whose words
        at a cut are left to the window that holds them whole."""
        parts, out = _parts(token), []
        for i, part in enumerate(parts):
            read = self.decode(part).split()
            out += read[int(i > 0):len(read) - int(i < len(parts) - 1)] if len(read) > 2 else read
        return out

    def words(self, token: str) -> list[str]:
        """The restored words of one token (lower-cased, without signs at its ends)."""
        token = token.strip(ENDS + SIGN_ENDS)
        token = token.strip("$@") if token[-2:] in ("$$", "@@") or token[:2] in ("$$", "@@") else token
        if not token:
            return []
        if len(token) > 64:
            token = _STRETCHED.sub(r"\1\1\1", token)
        if token.isalpha() and not _TRIPLE.search(token):
            return [token]
        if self.suspicious(token):
            return self.long_words(token)
        return re.findall(r"[^\W\d_]+", token)

    def alternatives(self, token: str) -> list[str]:
        """Words of the other readings of one token: signs at its ends as letters, doubled letters as single ones."""
        outer = token.strip(ENDS)
        core = outer.strip(ENDS + SIGN_ENDS)
        if not any(c.isalpha() for c in core):
            return []
        out: list[str] = []
        if core != outer:
            first = outer.index(core)
            last = first + len(core)
            lead = frozenset([first - 1] if first and outer[first - 1] in SIGNS else [])
            trail = frozenset([last] if last < len(outer) and outer[last] in SIGNS else [])
            # places beyond a few signs next to the word are left out of the lattice
            for forced in {lead, trail, lead | trail} - {frozenset()}:
                start, end = (first - 1 if lead & forced else first), (last + 1 if trail & forced else last)
                places = frozenset(i - start for i in forced)
                out += self.decode(outer[start:end], places).split() if end - start <= 2 * RUN_PART else self.long_words(outer[start:end])
        for word in dict.fromkeys([*self.words(token), *out]):
            doubled = [m.span() for m in _DOUBLE.finditer(word)]
            if not doubled:
                continue
            out.append(_DOUBLE.sub(r"\1", word))
            if len(doubled) > DOUBLES:
                out += self.long_words(word)
                continue
            for choice in range(1, 1 << len(doubled)):
                parts, at = [], 0
                for k, (a, b) in enumerate(doubled):
                    parts.append(word[at:a] + (word[a] if choice >> k & 1 else word[a] * 2))
                    at = b
                out.append("".join(parts) + word[at:])
        return list(dict.fromkeys(out))


def features_of(word: str) -> list[str]:
    """The word, and the beginnings of one of four letters or more with a sign that tells them from words."""
    if len(word) < 4:
        return [word]
    return [word, *{f"{word[:k]}*" for k in (4, 5, 6) if len(word) >= k}]


class Tokens:
    """Values of the distinct restored words of a text; each distinct token is read once."""

    def __init__(self, restorer: Restorer, value_of_word):
        self.restorer, self.value = restorer, value_of_word
        self.memo: dict[str, object] = {}

    def _values(self, words: list[str]) -> list:
        return [v for v in map(self.value, words) if v is not None]

    def of_text(self, text: str) -> list:
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        lowered = text.lower()
        tokens = set(lowered.split())
        memo, found = self.memo, []
        for token in tokens:
            if token not in memo:
                memo[token] = (self._values(self.restorer.words(token)) or self._values(self.restorer.alternatives(token))[:1]) or None
            if memo[token]:
                found += memo[token]
        for run in _RUN.finditer(lowered):
            spread = _spread(run.group())
            for part in _parts(spread) if spread else ():
                for word in self.restorer.decode(part).split():
                    if len(word) > 2 and (value := self.value(word)) is not None:
                        found.append(value)
        return found


def _counted(texts: DataFrame, logs, value_of_word) -> DataFrame:
    """(feature, seen): in how many texts each feature occurs; ``value_of_word`` lists a word's features."""

    def count(stream):
        tokens, seen = Tokens(Restorer(logs.value), value_of_word), Counter()
        for batch in stream:
            for text in batch.column("text").to_pylist():
                seen.update({f for features in tokens.of_text(text or "") for f in features})
            if len(seen) > 4 * MEMO_ENTRIES:
                yield pa.RecordBatch.from_pydict({"feature": list(seen), "seen": pa.array(seen.values(), type=pa.int64())})
                seen = Counter()
        if seen:
            yield pa.RecordBatch.from_pydict({"feature": list(seen), "seen": pa.array(seen.values(), type=pa.int64())})

    return map_batches(texts.select("text"), count, "feature string, seen long").groupBy("feature").agg(F.sum("seen").alias("seen"))


#: Columns of a text's findings: greatest weight, sum of the three greatest, number of findings.
FOUND = ("__x0", "__x1", "__x2")


def _findings(docs: DataFrame, logs, lexicon) -> DataFrame:
    """``docs`` with the columns FOUND."""
    columns = docs.columns

    def work():
        weights = lexicon.value

        def value(word):
            best = max((weights.get(f, 0.0) for f in features_of(word)), default=0.0)
            return best or None

        tokens = Tokens(Restorer(logs.value), value)

        def run(batch):
            rows = [sorted(tokens.of_text(x or ""), reverse=True) for x in batch.column("text").to_pylist()]
            found = [[r[0] if r else 0.0 for r in rows], [sum(r[:3]) for r in rows], [math.log1p(len(r)) for r in rows]]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], *[pa.array(c, type=pa.float64()) for c in found]],
                                              [*columns, *FOUND])

        return run

    schema = docs.select("*", *[F.lit(0.0).alias(c) for c in FOUND]).schema
    return batches(docs, work, schema)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-3, *[1.0] * (x.shape[1] - 1)])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def chance(toxic: int, clean: int, share: float) -> float:
    """The chance that of ``toxic + clean`` texts at least ``toxic`` are toxic, if a ``share`` of texts is."""
    n = toxic + clean
    logs = (math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)
            for k in range(toxic, n + 1))
    return math.fsum(map(math.exp, logs))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``__score``, learnt from ``labels`` (doc_id, toxic) of rows that
    are not held out."""
    context = docs.sparkSession.sparkContext
    logs = context.broadcast(log_probabilities(trigram_counts(docs)))
    known = materialize(labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
                        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")), "toxicity-labels")
    chosen = sample_condition(known.count(), sample, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~held_out(F.col("doc_id")) & chosen)
    learnt = materialize(texts.join(known.where(chosen), "doc_id").select("text", "toxic"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in learnt.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        return docs.withColumn("__score", F.lit(0.0))

    frequent = (_counted(learnt.where("toxic = 1"), logs, lambda word: features_of(word) or None)
                .where(F.col("seen") >= LEAST_SEEN))
    toxic_seen = {r["feature"]: r["seen"] for r in frequent.collect()}
    candidates = context.broadcast(frozenset(toxic_seen))

    def known_features(word):
        return [f for f in features_of(word) if f in candidates.value] or None

    clean_seen = {r["feature"]: r["seen"] for r in _counted(learnt.where("toxic = 0"), logs, known_features).collect()}
    odds = {f: math.log((n + 0.5) / (ones + 1)) - math.log((clean_seen.get(f, 0) + 0.5) / (zeros + 1)) for f, n in toxic_seen.items()}
    share = ones / (ones + zeros)
    lexicon = context.broadcast({f: w for f, w in odds.items() if w >= LEAST_LOG_ODDS and (
        100 * toxic_seen[f] >= ones or chance(toxic_seen[f], clean_seen.get(f, 0), share) <= RARE_CHANCE)})

    fitted = _findings(learnt, logs, lexicon).select("toxic", *FOUND).toPandas()
    weights = _logistic(fitted[list(FOUND)].to_numpy(), fitted["toxic"].to_numpy(dtype=np.float64))
    z = sum((F.col(c) * float(w) for c, w in zip(FOUND, weights[1:])), F.lit(float(weights[0])))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return _findings(docs, logs, lexicon).withColumn("__score", score).drop(*FOUND)


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text)."""
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, sample)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                        F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    return scored(docs, labels, sample).where(F.col("__score") < THRESHOLD).select(docs.columns)
