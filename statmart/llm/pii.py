"""Personal data: base patterns, and a skip-chain conditional random field for what they miss.

Base patterns (fixed values) give emails, IP addresses, cards and phones, each leftmost and without
overlap per kind; matches that fail their check are dropped. Tokens with a digit or ``@`` are nodes of a
random field with labels none, email, ip, card and phone:

* every node has a potential from its shape, digits, checks and neighbours' shapes (softmax
  regression), and base matches are evidence;
* neighbouring nodes share a potential learnt from how often their labels stand together;
* tokens anywhere in a document that repeat the same address, or the same digits in another
  dress, also over several neighbouring tokens, are linked by skip edges that favour equal
  labels to one variable for what they repeat; base matches hold it. Where a base match is repeated in another dress (``jane (at) example.com``,
  ``10.0.0[.]1``, digits in other groups), the tokens become one node, with the potentials of the
  match's own tokens, none above that of its label.

Loopy belief propagation passes messages along both sorts of edges until they settle; runs of tokens with one
label of belief of at least BELIEF that no base match touches, and whose digits pass the
label's check (or repeat a base match), become added spans. Parameters are learnt from the base matches of about
``sample`` documents with such tokens at most (chosen by hash); every document is tagged whole.

Defined results: null and empty texts have no spans; repeated rows repeat; an empty table gives none;
without any base match to learn from nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import batches, bounded_sample, map_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SAMPLE = 20_000
#: The field's unary potentials are fitted on so many token shapes at least, the commonest first.
SHAPES = 50_000
BELIEF = 0.8
#: Messages have settled when none changes by more.
SETTLED = 1e-4

# fixed values: the base patterns
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: White-space separated tokens with a digit or @. A match starts where a token does, so a token
#: without either is read once and not again from each of its characters.
_NODE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
# dresses of a base match: @ and dots spaced, in brackets or as words, other signs between octets
_AT = r"\s{0,3}[\[({<]?\s{0,3}(?:@|\bat\b)\s{0,3}[\])}>]?\s{0,3}"
_DOT = r"\s{0,2}[\[({<]?\s{0,2}(?:\.|\bdot\b)\s{0,2}[\])}>]?\s{0,2}"
_OCTETS = r"\s{0,2}[\[({<]?\s{0,2}(?:[.,:_-]|dot)\s{0,2}[\])}>]?\s{0,2}"
_MAIL_DRESS = re.compile(rf"(?<![a-z0-9._%+-])(?=([a-z0-9._%+-]+)({_AT})([a-z0-9-]+(?:{_DOT}[a-z0-9-]+)*))", re.ASCII | re.IGNORECASE)
_LABEL = re.compile(rf"(?:^|{_DOT})([a-z0-9-]+)", re.ASCII | re.IGNORECASE)
_IP_DRESS = re.compile(rf"(?<![0-9])(?=([0-9]{{1,3}}){_OCTETS}([0-9]{{1,3}}){_OCTETS}([0-9]{{1,3}}){_OCTETS}([0-9]{{1,3}})(?![0-9]))", re.ASCII | re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


def shape_of(token: str) -> str:
    """Runs of digits as 9, of letters as a, other characters themselves; shortened."""
    return re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]+", "9", token))[:24]


def nodes_of(text: str, base: list[tuple[int, int, int]]):
    """(start, end, label or -1, features, skip key) of each token with a digit or ``@``."""
    found = [(m.start(), m.end()) for m in _NODE.finditer(text)]
    marks = sorted((s, e, k + 1) for k, s, e in base)
    out, at = [], 0
    for i, (start, end) in enumerate(found):
        token = text[start:end].strip(".,;:!?\"'")
        first = start + text[start:end].find(token) if token else start
        while at < len(marks) and marks[at][1] <= start:
            at += 1
        label = next((k for s, e, k in marks[at:at + 3] if s < end and e > start), -1)
        digits = digits_of(token)
        shape = shape_of(token)
        left, right = text[max(0, start - 13):max(0, start - 1)].split(), text[end + 1:end + 13].split(None, 1)
        before, after = shape_of(left[-1]) if left else "^", shape_of(right[0]) if right else "$"
        checks = f"{16 <= len(digits) <= 19 and luhn(digits)}{token.count('.') == 3 and all(p.isdigit() and p.isascii() and _octet(p) for p in token.split('.'))}"
        features = (f"s {shape}", f"d {min(len(digits), 20)}", f"c {checks} {shape}", f"@ {'@' in token}", f"b {before} {shape}", f"a {after} {shape}")
        key = token.lower() if "@" in token else digits[-7:] if len(digits) >= 7 else ""
        out.append((first, first + len(token), label, features, key, start, end))
    return out


def key_of(kind: int, match: str) -> str:
    """What a base match says whatever its dress."""
    if kind == 0:
        local, _, domain = match.lower().partition("@")
        return f"{local.strip('._%+-')}@{domain}"
    return ".".join(str(int(x)) for x in match.split(".")) if kind == 1 else digits_of(match)[-7:]


def _dressed_addresses(text: str, base) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, key) of repeats of the base emails and IP addresses in another dress."""
    out, mails, ips = [], {}, set()
    for k, s, e in base:
        if k == 0:
            local, _, domain = key_of(0, text[s:e]).partition("@")
            mails.setdefault((local, domain.split(".")[0]), set()).add(tuple(domain.split(".")))
        elif k == 1:
            ips.add(key_of(1, text[s:e]))
    for m in _MAIL_DRESS.finditer(text) if mails else ():
        local, labels = m.group(1).lower(), [(x.group(1).lower(), x.end()) for x in _LABEL.finditer(m.group(3))]
        known = mails.get((local.strip("._%+-"), labels[0][0]), ())
        same = max(((sum(1 for _ in takewhile(lambda x: x[0] == x[1][0], zip(k, labels))), k) for k in known), default=(0, ()))
        # the word "at" alone needs the whole domain
        if same[0] and (same[0] == len(same[1]) or m.group(2).strip().lower() != "at"):
            start = m.start(1) + len(local) - len(local.lstrip("._%+-"))
            out.append((start, m.start(3) + labels[same[0] - 1][1], 0, f"{local.strip('._%+-')}@{'.'.join(same[1])}"))
    for m in _IP_DRESS.finditer(text) if ips else ():
        key = ".".join(str(int(x)) for x in m.groups())
        if key in ips:
            out.append((m.start(1), m.end(4), 1, key))
    return out


def _number_runs(text: str, nodes) -> list[list[int]]:
    """Runs of neighbouring nodes without letters, ``@`` or base match."""
    runs: list[list[int]] = []
    for i, n in enumerate(nodes):
        if n[2] > 0 or not n[4] and not digits_of(text[n[0]:n[1]]) or any(c.isalpha() or c == "@" for c in text[n[0]:n[1]]):
            continue
        if runs and runs[-1][-1] == i - 1 and not text[nodes[i - 1][6]:n[5]].strip(" "):
            runs[-1].append(i)
        else:
            runs.append([i])
    return runs


def _dressed_numbers(text: str, nodes, base) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, key) of repeats of the base cards and phones over neighbouring tokens."""
    known: dict[str, set] = {}
    for k, s, e in base:
        if k >= 2:
            known.setdefault(key_of(k, text[s:e]), set()).add((k, digits_of(text[s:e])))
    out = []
    for run in _number_runs(text, nodes) if known else ():
        own = [digits_of(text[nodes[i][0]:nodes[i][1]]) for i in run]
        ends = np.cumsum([len(x) for x in own]).tolist()
        digits, j = "".join(own), len(run) - 1
        while j >= 0:
            best = None
            for kind, number in known.get(digits[max(0, ends[j] - 7):ends[j]], ()):
                same = 0
                while same < min(len(number), ends[j]) and number[-1 - same] == digits[ends[j] - 1 - same]:
                    same += 1
                first = j
                while first > 0 and ends[first - 1] > ends[j] - same:
                    first -= 1
                start, bound = ends[first] - len(own[first]), ends[j] - same
                if start < bound and digits[start:bound].strip("0"):  # other digits before: that token is no part
                    first, start = first + 1, ends[first]
                if first <= j and ends[j] - start >= (len(number) if kind == 2 else 7) and ends[j] - start <= 15 + 4 * (kind == 2):
                    best = min(best or (first, kind), (first, kind))
            if best:
                out.append((nodes[run[best[0]]][0], nodes[run[j]][1], best[1], digits[ends[j] - 7:ends[j]]))
                j = best[0]
            j -= 1
    return out


def with_repeats(text: str, nodes, base):
    """``nodes`` with one node (features: a list of its label and those of the base match's tokens) for each
    repeat of a base match in another dress, and the kind of these by place."""
    taken = sorted((s, e) for _, s, e in base)
    found, done, at = [], 0, 0
    for s, e, kind, key in sorted([*_dressed_addresses(text, base), *_dressed_numbers(text, nodes, base)], key=lambda x: (x[0], -x[1])):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if s >= done and not any(a < e and b > s for a, b in taken[at:at + 4]):
            found.append((s, e, kind, key))
            done = e
    if not found:
        return nodes, {}
    own: dict[tuple, list] = {}
    for (k, s, e), tokens in zip(base, _tokens_of(nodes, base)):
        if tokens:
            own.setdefault((k, key_of(k, text[s:e])), [nodes[i][3] for i in tokens])
    out, at = [], 0
    for s, e, kind, key in found:
        while at < len(nodes) and nodes[at][6] <= s:
            out.append(nodes[at])
            at += 1
        while at < len(nodes) and nodes[at][5] < e:
            at += 1
        out.append((s, e, -1, [kind + 1, *own[kind, key]], key, s, e))
    marks = {(s, e): kind for s, e, kind, _ in found}
    out += nodes[at:]
    return out, {i: marks[n[0], n[1]] for i, n in enumerate(out) if isinstance(n[3], list)}


def _tokens_of(nodes, base) -> list[list[int]]:
    """The nodes that each base match touches."""
    starts, out = [n[5] for n in nodes], []
    for _, s, e in base:
        i, touched = max(0, bisect_right(starts, s) - 1), []
        while i < len(nodes) and nodes[i][5] < e:
            if nodes[i][6] > s:
                touched.append(i)
            i += 1
        out.append(touched)
    return out


def edges_of(text: str, nodes, base):
    """Chain edges of tokens next to each other; skip edges (node, hub) to one hub for each key that
    occurs twice or more, a key being an address or seven digits that end a token or run of tokens;
    and the hubs' labels by base matches (0 none, several if matches differ)."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if not text[nodes[i][6]:nodes[i + 1][5]].strip(" ")]
    seen: dict[str, set] = {}
    for i, node in enumerate(nodes):
        if node[4]:
            seen.setdefault(node[4], set()).add((i,))
    for run in _number_runs(text, nodes):
        own = [digits_of(text[nodes[i][0]:nodes[i][1]]) for i in run]
        for j in range(1, len(run)):
            first, tail = j, own[j]
            while len(tail) < 7 and first > 0:
                first -= 1
                tail = own[first] + tail
            if first < j and len(tail) >= 7:
                seen.setdefault(tail[-7:], set()).add(tuple(run[first:j + 1]))
    held: dict[str, set] = {}
    for (k, s, e), tokens in zip(base, _tokens_of(nodes, base)):
        key = key_of(k, text[s:e])
        held.setdefault(key, set()).add(k + 1)
        seen.setdefault(key, set()).update((i,) for i in tokens)
    skip, hubs = [], []
    for key, places in seen.items():
        if len(places) > 1:
            skip += [(i, len(hubs)) for i in sorted({i for place in places for i in place})]
            hubs.append(sorted(held.get(key, ())))
    return chain, skip, hubs


class Field:
    """Learnt potentials and loopy belief propagation."""

    def __init__(self, weights: dict[str, np.ndarray], bias: np.ndarray, chain: np.ndarray, skip: float):
        self.weights, self.bias = weights, bias
        self.chain, self.skip = chain, skip * np.eye(len(LABELS))

    def parts(self) -> tuple:
        """Plain values from which tasks build the field again."""
        return self.weights, self.bias, self.chain, float(self.skip[0, 0])

    def unary(self, features) -> np.ndarray:
        if isinstance(features, list):  # a repeat: those of the tokens it repeats, whose label is known
            label, *tokens = features
            phi = np.mean([self.unary(f) for f in tokens], axis=0)
            phi[label] = phi.max()
            return phi
        return self.bias + sum((self.weights[f] for f in features if f in self.weights), np.zeros(len(LABELS)))

    def beliefs(self, nodes, chain, skip, hubs) -> np.ndarray:
        """Marginals of the nodes' labels; base matches hold their label."""
        phi = np.array([*[self.unary(n[3]) for n in nodes], *np.zeros((len(hubs), len(LABELS)))])
        for i, n in enumerate(nodes):
            if n[2] > 0:
                phi[i] = -30.0
                phi[i, n[2]] = 0.0
        for i, kinds in enumerate(hubs):
            if kinds:
                phi[len(nodes) + i] = -30.0
                phi[len(nodes) + i, kinds] = 0.0
        links = [*chain, *((i, len(nodes) + h) for i, h in skip)]
        if not links:
            return _softmax(phi)
        source = np.array([a for a, _ in links] + [b for _, b in links])
        target = np.array([b for _, b in links] + [a for a, _ in links])
        pair = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0),
                               np.repeat(self.chain.T[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
        back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
        messages = np.zeros((len(source), len(LABELS)))
        rounds, share, change = 0, 0.5, 1.0
        while change > SETTLED:
            total = phi.copy()
            np.add.at(total, target, messages)
            inner = total[source] - messages[back]
            new = _logsumexp(inner[:, :, None] + pair)
            new -= new.max(axis=1, keepdims=True)
            change = share * np.abs(new - messages).max()
            messages = (1 - share) * messages + share * new
            rounds += 1
            if rounds % (100 + len(nodes)) == 0:  # messages that swing get smaller steps
                share /= 2
        total = phi.copy()
        np.add.at(total, target, messages)
        return _softmax(total[:len(nodes)])


def _logsumexp(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0, :]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def plausible(kind: int, text: str) -> bool:
    """Can a span be what its label says? (An ip needs four octets, a card its checksum.)"""
    if kind == 0:
        return bool(re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]", text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", text)) and all(map(_octet, text.split(".")))
    digits = digits_of(text)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 7 <= len(digits) <= 15


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """Spans the field adds: runs of neighbouring tokens of one believed label free of base matches."""
    nodes, repeats = with_repeats(text, nodes_of(text, base), base)
    if not nodes:
        return []
    chain, skip, hubs = edges_of(text, nodes, base)
    beliefs = field.beliefs(nodes, chain, skip, hubs)
    labels = np.where(beliefs.max(axis=1) >= BELIEF, beliefs.argmax(axis=1), 0)
    joined, out = set(chain), []
    for i, node in enumerate(nodes):
        if labels[i] == 0 or node[2] > 0 or node[0] == node[1]:
            continue
        if out and out[-1][3] == i - 1 and (i - 1, i) in joined and out[-1][0] == labels[i] - 1 and i not in repeats and i - 1 not in repeats:
            out[-1] = (out[-1][0], out[-1][1], node[1], i)
        else:
            out.append((int(labels[i]) - 1, node[0], node[1], i))
    return [(k, s, e) for k, s, e, i in out if repeats.get(i) == k or plausible(k, text[s:e])]


def learn_field(docs: DataFrame, sample: int = SAMPLE, shapes: int = SHAPES) -> Field | None:
    """Potentials learnt from base matches of about ``sample`` documents at most, with candidate tokens.

    The unary potentials are fitted on the ``shapes`` commonest shapes of tokens (with their labels); the
    counts for chain and skip potentials, at most a row for each pair of labels, always come whole.
    """
    chosen = bounded_sample(docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]")), sample, "doc_id", "text").select("text")

    def count(stream):
        seen: Counter = Counter()
        for batch in stream:
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                nodes = nodes_of(text, base)
                labels = [max(0, n[2]) for n in nodes]
                for n, label in zip(nodes, labels):
                    seen["\x1f".join(("n", *n[3])), label] += 1
                for a, b in edges_of(text, nodes, base)[0]:
                    seen[f"c\x1f{labels[a]}", labels[b]] += 1
                # what repeats a base match in another dress has no label of its own to learn from
                nodes, repeats = with_repeats(text, nodes, base)
                labels, (_, skip, hubs) = [max(0, n[2]) for n in nodes], edges_of(text, nodes, base)
                for a, h in ((a, h) for a, h in skip if a not in repeats):
                    seen[f"k\x1f{labels[a] if labels[a] in hubs[h] else max(hubs[h], default=0)}", labels[a]] += 1
        if seen:
            yield pa.RecordBatch.from_pydict({"what": [k for k, _ in seen], "label": pa.array([v for _, v in seen], type=pa.int32()),
                                              "seen": pa.array(seen.values(), type=pa.int64())})

    rows = (map_batches(chosen, count, "what string, label int, seen long").groupBy("what", "label").agg(F.sum("seen").alias("seen"))
            .orderBy(F.col("what").startswith("n\x1f"), F.desc("seen"), "what", "label")
            .limit(shapes + 2 * len(LABELS) ** 2).collect())
    nodes = [(r["what"].split("\x1f")[1:], r["label"], r["seen"]) for r in rows if r["what"].startswith("n")]
    if not any(label for _, label, _ in nodes):
        return None
    size = len(LABELS)
    chain, same, other = np.full((size, size), 0.5), 1.0, 1.0
    for r in rows:
        sort, _, a = r["what"].partition("\x1f")
        if sort == "c":
            chain[int(a), r["label"]] += r["seen"]
        elif sort == "k":
            same, other = (same + r["seen"], other) if int(a) == r["label"] else (same, other + r["seen"])
    chain /= chain.sum()
    ratio = np.log(chain / np.outer(chain.sum(axis=1), chain.sum(axis=0)))
    weights, bias = _regression(nodes, size)
    return Field(weights, bias, 0.5 * np.clip(ratio, -3, 3), float(np.clip(np.log(same / other), 0.5, 4.0)))


def _regression(nodes, size: int, steps: int = 300) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Softmax regression on (features, label, count) rows, by gradient steps with momentum."""
    names = {f: i for i, f in enumerate(dict.fromkeys(f for features, _, _ in nodes for f in features))}
    places = np.array([[names[f] for f in features] for features, _, _ in nodes])
    wanted = np.eye(size)[[label for _, label, _ in nodes]]
    mass = np.minimum(np.array([n for _, _, n in nodes], dtype=np.float64), 200.0)[:, None]
    w, b = np.zeros((len(names), size)), np.zeros(size)
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    scale = np.zeros((len(names), 1))
    np.add.at(scale, places.ravel(), np.repeat(mass, places.shape[1], axis=0))
    for _ in range(steps):
        error = (wanted - _softmax(w[places].sum(axis=1) + b)) * mass
        slope = np.zeros_like(w)
        np.add.at(slope, places.ravel(), np.repeat(error, places.shape[1], axis=0))
        speed_w = 0.8 * speed_w + 0.5 * (slope - 0.3 * w) / (scale + 1.0)
        speed_b = 0.8 * speed_b + 0.5 * error.sum(axis=0) / mass.sum()
        w, b = w + speed_w, b + speed_b
    return {f: w[i] for f, i in names.items()}, b


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _shared_field(docs: DataFrame, sample: int):
    field = learn_field(docs, sample)
    return docs.sparkSession.sparkContext.broadcast(field.parts() if field else None)


def find_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs``
    (doc_id, text): counts and digest of the base matches; all spans in order."""
    parts = _shared_field(docs, sample)

    def work():
        field = Field(*parts.value) if parts.value else None

        def run(batch):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                more = added_spans(text, base, field) if text and field else []
                counts = Counter(k for k, _, _ in base)
                rows.append((*[counts[k] for k in range(4)], hashlib.sha256(written(base).encode()).hexdigest(), written([*base, *more])))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)]],
                                              ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

        return run

    return batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work,
                   "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, and ``n_chars`` set anew.
    Overlapping spans become one, named after the first."""
    parts = _shared_field(docs, sample)
    columns = docs.columns

    def clean(text: str, field: Field | None) -> str:
        base = base_spans(text)
        spans = sorted((s, e, k) for k, s, e in [*base, *(added_spans(text, base, field) if field else [])])
        out, done = [], 0
        for start, end, kind in spans:
            if start >= done:
                out.append(text[done:start] + f"[{KINDS[kind].upper()}]")
            done = max(done, end)
        return "".join([*out, text[done:]]) if spans else text

    def work():
        field = Field(*parts.value) if parts.value else None

        def run(batch):
            texts = [x if x is None else clean(x, field) for x in batch.column("text").to_pylist()]
            new = {"text": pa.array(texts, type=pa.string()), "n_chars": pa.array([None if x is None else len(x) for x in texts], type=pa.int64())}
            return pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], columns)

        return run

    typed = docs.withColumn("n_chars", F.col("n_chars").cast("long")) if "n_chars" in columns else docs
    return batches(typed, work, typed.schema)
