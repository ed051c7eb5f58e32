"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks.

A text is cut into sentences, a sentence into strings: its words, lower-cased, signs
inside them dropped, a letter put between every two taken out, letters spelled one by
one put together. Two strings are compared by the gap-weighted subsequence kernel: the
common subsequences of three characters, their ends marked, each damped by the gaps it
stretches over, as a share of the strings' own (so equal strings have 1). Characters
put in or left out lower it a little; a longer word around an insult lowers it more. The
kernel of two sentences is the sum, over all pairs of their strings, of that share to
the power POWER. Landmarks are strings of labelled sentences of both classes; a
sentence's features are K(s, L) K(L, L)^-1/2, and a linear support vector machine is
trained on labelled sentences.

All sentences of clean documents are negative. A toxic document says only that some
sentence is toxic: the one that scores highest stands for it, chosen anew after each
fit. A document's score is a logistic function, fitted on documents that the machine
was not trained on, of its highest sentence and of what all its sentences have above
a margin, by the root of their number.

Landmarks: half are strings around character runs that tell toxic documents from clean
ones, each run in turn; then the clean strings that look most like these; the rest are
drawn from clean sentences. Training takes at most SAMPLE labelled documents of each
class, the least by a keyed hash of the id, of at most LENGTH characters (longer ones
are scored, not learned from), and at most SENTENCES sentences of each class. Every
text is scored whole. Null, empty and wordless texts get the score of a text without
features. Rows of equal doc_id are one in training. Without both classes among the
labels all scores are 0.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantagrid.llm.common import bounded_batches, utf8

#: Characters in a subsequence, the longest stretch one is spread over, its damping for each character left out.
ORDER, SPAN, DAMPING = 3, 7, 0.85
#: Power of the kernel of two strings in that of two sentences.
POWER = 3
#: Landmarks, and characters of a run that tells.
LANDMARKS, RUN = 320, 5
#: Labelled documents of each class that a model is trained on, at most; their length; sentences of each class.
SAMPLE, LENGTH, SENTENCES = 1200, 50_000, 12_000
#: Log-likelihood ratio a run needs; chance exceeds it once in a million runs.
EVIDENCE = 24
#: Words of a sentence that are read together; characters of a word that are; words whose scores a task remembers.
WIDE, LONG, REMEMBERED = 24, 4096, 300_000
#: From this score on a document counts as toxic.
THRESHOLD = 0.7
#: Documents of a class from half of which on two parts are enough to judge the scores.
JUDGED = 600
#: Cost of the machine's errors; sentences count towards a document's sum from this margin on.
COST, FROM = 10.0, -0.5

_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_SIGNS = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)[^\W_](?:[ \t]+[^\W_]){2,}(?!\S)")
#: Letters told apart, beside the two ends; any other matches nothing.
LETTERS = 61
_BEGIN, _END, _OTHER = 0, 1, 63
_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def shaped(token: str) -> str:
    """A word without signs, and without a letter that stands between every two of it."""
    word = _SIGNS.sub("", token)
    if len(word) >= 7:
        between = word[1]
        if word[1::2] == between * (len(word) // 2) and between not in word[0::2]:
            return word[0::2]
    return word


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence, as they stand; long sentences in runs of WIDE words, long words in stretches of LONG."""
    text = text.lower()
    if _SPELLED.search(text):
        text = _SPELLED.sub(lambda m: "".join(m[0].split()), text)
    out = []
    for s in _SENTENCE.split(text):
        words = s.split()
        if len(s) > LONG:
            words = [w[k : k + LONG] for w in words for k in range(0, len(w), LONG)]
        out += [words[k : k + WIDE] for k in range(0, len(words), WIDE)]
    return out


class Strings:
    """The letters told apart, and the features of strings: their subsequences of ORDER characters."""

    def __init__(self, texts: list[str]):
        common = Counter(c for t in texts for c in t.lower() if not c.isspace())
        self.code = np.full(0x110000, _OTHER, np.int8)
        for k, (c, _) in enumerate(sorted(common.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]):
            self.code[ord(c)] = k + 2

    def features(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(which words, row among these, subsequence, weight) of blocks of words of like length; a word's squares add up to 1."""
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            high = at + 1
            while high < len(order) and (high - at + 1) * (int(size[order[high]]) + 2) <= 2500:
                high += 1
            some = order[at:high]
            at = high
            yield (some, *self._block([words[k] for k in some.tolist()], size[some]))

    def _block(self, words: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = int(size[-1]) + 2
        chars = np.full((len(words), width), _OTHER, np.int64)
        inside = np.arange(width - 2) < size[:, None]
        chars[:, 1:-1][inside] = self.code[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.int32)]
        chars[:, 0] = _BEGIN
        chars[np.arange(len(words)), size + 1] = _END
        keys = []
        known = chars != _OTHER
        row = np.arange(len(words))[:, None] << 21
        for a, b in _GAPS:
            if b < width:
                x, y, z = slice(0, width - b), slice(a, width - b + a), slice(b, width)
                key = row | chars[:, x] << 15 | chars[:, y] << 9 | chars[:, z] << 3 | (b - 2)
                keys.append(key[known[:, x] & known[:, y] & known[:, z]])
        key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        weight = (DAMPING ** np.arange(8))[key & 7]
        begin = np.flatnonzero(np.append(True, key[1:] >> 3 != key[:-1] >> 3)[: len(key)])
        weight = np.add.reduceat(weight, begin) if len(begin) else weight
        key = key[begin] >> 3
        own = key >> 18
        scale = np.sqrt(np.bincount(own, weight * weight, minlength=len(words)))
        return own, key & 0x3FFFF, (weight / scale[own]).astype(np.float32)


class Kernel:
    """The kernel of strings with fixed landmarks, each value from 0 to 1."""

    def __init__(self, strings: Strings, landmarks: list[str]):
        self.strings, self.landmarks, self.m = strings, landmarks, len(landmarks)
        found = [(some[own], sub, weight) for some, own, sub, weight in strings.features(landmarks)]
        mark, sub, weight = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(sub, kind="stable")
        self.mark, self.weight = mark[order], weight[order].astype(np.float64)
        count = np.bincount(sub, minlength=1 << 18)
        self.count, self.begin = count.astype(np.int32), (np.cumsum(count) - count).astype(np.int32)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.m), np.float32)
        for some, own, sub, weight in self.strings.features(words):
            # every subsequence meets the few landmarks that have it
            n = self.count[sub]
            which = np.repeat(np.arange(len(sub)), n)
            at = (self.begin[sub] - (np.cumsum(n) - n))[which]
            at += np.arange(len(which))
            cell = (own * self.m)[which]
            cell += self.mark[at]
            value = np.bincount(cell, weight[which] * self.weight[at], minlength=len(some) * self.m)
            out[some] = value.reshape(len(some), self.m)
        return np.minimum(out, 1)


def powered(kernel: np.ndarray) -> np.ndarray:
    """To the power POWER, by products."""
    out = kernel
    for _ in range(POWER - 1):
        out = out * kernel
    return out


def runs(word: str) -> set[str]:
    """Runs of RUN characters of a word, its ends marked."""
    word = f"^{word}$"
    return {word[i : i + RUN] for i in range(max(1, len(word) - RUN + 1))}


def evidence(c: int, z: int, n1: int, n0: int) -> float:
    """Log-likelihood ratio that a run favours toxic texts: in c of n1 toxic and z of n0 clean ones; 0 if it does not."""
    share = (c + z) / (n1 + n0)
    if c * n0 <= z * n1:
        return 0.0
    return 2 * (c * math.log(c / (n1 * share)) + (z * math.log(z / (n0 * share)) if z else 0))


def drawn(items: list[str], n: int) -> list[str]:
    """``n`` of the strings, the least by a keyed hash."""
    return sorted(items, key=lambda s: (zlib.crc32(s.encode(), 29), s))[:n]


def telling_runs(toxic: list[set[str]], clean: list[set[str]]) -> dict[str, float]:
    """Evidence of the runs that toxic documents have, each document a set of strings."""
    one, zero = Counter[str](), Counter[str]()
    for docs, count in ((toxic, one), (clean, zero)):
        for words in docs:
            count.update({r for w in words for r in runs(w)})
    found = {r: evidence(c, zero[r], len(toxic), len(clean)) for r, c in one.items()}
    return {r: e for r, e in found.items() if e > 0}


class Worth(dict):
    """The evidence of a string's most telling run."""

    def __init__(self, telling: dict[str, float]):
        self.telling = telling

    def __missing__(self, word: str) -> float:
        self[word] = value = max((self.telling.get(r, 0.0) for r in runs(word)), default=0.0)
        return value

    def most(self, words: list[str]) -> float:
        return max(map(self.__getitem__, words))


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]], telling: dict[str, float], worth: Worth, m: int) -> list[str]:
    """Strings of toxic documents around telling runs, the clean ones most like them, and clean ones as drawn."""
    strong = sorted((r for r, e in telling.items() if e >= EVIDENCE), key=lambda r: (-telling[r], r))
    held: dict[str, set[str]] = {r: set() for r in strong}
    for w in {w for words in toxic for w in words if worth[w] >= EVIDENCE}:
        for r in runs(w) & held.keys():
            held[r].add(w)
    queues = [drawn(sorted(held[r]), m) for r in strong]
    out: dict[str, None] = {}
    for turn in range(max(map(len, queues), default=0)):
        for q in queues:
            if turn < len(q) and len(out) < m // 2:
                out.setdefault(q[turn])
    for w in drawn(sorted({w for words in toxic for w in words}), m):
        if len(out) < m // 4:
            out.setdefault(w)
    good = sorted({w for words in clean for w in words} - out.keys())
    for w in sorted(good, key=lambda w: (-worth[w], w))[: m // 4]:
        out.setdefault(w)
    for w in drawn(good, m):
        if len(out) < m:
            out.setdefault(w)
    return list(out)


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps on the active set; the last coefficient is the bias."""
    ridge = np.eye(x.shape[1] + 1)
    ridge[-1, -1] = 1e-6
    active = np.ones(len(x), bool) if start is None else y * (x @ start[:-1].astype(np.float32) + start[-1]) < 1
    w = np.zeros(x.shape[1] + 1)
    for _ in range(40):
        left, right = ridge.copy(), np.zeros(len(w))
        some = np.flatnonzero(active)
        for at in range(0, len(some), 8192):
            k = some[at : at + 8192]
            part = np.column_stack([x[k], np.ones(len(k))]).astype(np.float64)
            scaled = part * (weight[k] * COST)[:, None]
            left += scaled.T @ part
            right += scaled.T @ y[k]
        w = np.linalg.solve(left, right)
        now = y * (x @ w[:-1].astype(np.float32) + w[-1]) < 1
        if (now == active).all():
            break
        active = now
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and offset of the probability at even odds of the classes, with the targets drawn in from 0 and 1."""
    n1, n0 = max((y > 0).sum(), 1), max((y < 0).sum(), 1)
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = 1e-4 * np.eye(len(w))
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) * weight)[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ ((p - target) * weight) + ridge @ w)
        w = w - np.clip(step, -2, 2)
        if abs(step).max() < 1e-8:
            break
    return w


def document_features(margins: np.ndarray, counts: np.ndarray, empty: float) -> np.ndarray:
    """(highest sentence, sum of what sentences have above FROM by the root of their number) of each document."""
    out = np.zeros((len(counts), 2))
    out[:, 0] = empty
    some = np.flatnonzero(counts)
    if len(some):
        begin = (np.cumsum(counts) - counts)[some]
        out[some, 0] = np.maximum.reduceat(margins, begin)
        out[some, 1] = np.add.reduceat(np.maximum(margins - FROM, 0), begin) / np.sqrt(counts[some])
    return out


class Words:
    """What words weigh for one machine. A process remembers those of the machine it used last, from task to task.

    When there are too many, those that were not met since the last time go.
    """

    def __init__(self):
        self.of, self.now, self.before = 0, {}, {}

    def forget(self) -> None:
        self.of, self.now, self.before = 0, {}, {}

    def ready(self, of: int) -> dict[str, float]:
        if of != self.of:
            self.forget()
            self.of = of
        elif len(self.now) > REMEMBERED:
            self.now, self.before = {}, self.now
        return self.now


_WORDS = Words()


@dataclass
class Model:
    """A fitted machine; ``beta`` weighs the landmarks, ``logistic`` the document's features."""

    kernel: Kernel
    beta: np.ndarray
    bias: float
    logistic: np.ndarray
    number: int = 0

    def __post_init__(self):
        self.number = zlib.crc32("\n".join(self.landmarks).encode(), zlib.crc32(self.beta.tobytes()))

    @property
    def landmarks(self) -> list[str]:
        return self.kernel.landmarks

    def margins(self, found: list[list[str]]) -> np.ndarray:
        """Of sentences that have words."""
        known = _WORDS.ready(self.number)
        tokens = [w for s in found for w in s]
        fresh = {w for w in tokens if w not in known}
        if _WORDS.before:
            known.update((w, _WORDS.before[w]) for w in fresh if w in _WORDS.before)
        fresh = sorted(w for w in fresh if w not in known)
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            known.update(zip(some, (powered(self.kernel([shaped(w) for w in some])) @ self.beta).tolist(), strict=True))
        value = np.fromiter(map(known.__getitem__, tokens), float, len(tokens))
        begin = np.cumsum([0, *map(len, found)])[:-1]
        return (np.add.reduceat(value, begin) if len(begin) else np.zeros(0)) + self.bias

    def features(self, texts: list[str]) -> np.ndarray:
        """Of documents, a few texts at a time."""
        parts, at = [np.zeros((0, 2))], 0
        while at < len(texts):
            found, counts, size = [], [], 0
            while at < len(texts) and size < 1 << 20:
                own = sentences(texts[at])
                found += own
                counts.append(len(own))
                size += len(texts[at])
                at += 1
            parts.append(document_features(self.margins(found), np.array(counts), self.bias))
        return np.concatenate(parts)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.logistic[:-1] + self.logistic[-1], -60, 60)))


def _chosen(score: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The highest sentence of each document, and all that score above 0."""
    order = np.lexsort((np.arange(len(score)), -score, owner))
    return order[np.append(True, owner[order][1:] != owner[order][:-1]) | (score[order] > 0)]


def fit_sentences(kernel: Kernel, root: np.ndarray, bad: list[list[str]], owner: np.ndarray, good: list[list[str]], worth: Worth, rounds: int = 5) -> tuple[np.ndarray, float]:
    """Weights of the landmarks and bias, from sentences of shaped strings; ``owner`` numbers the toxic documents."""
    both = bad + good
    x = np.empty((len(both), len(root)), np.float32)
    # a few sentences at a time: what is held is their words' features
    for at in range(0, len(both), 2048):
        some = both[at : at + 2048]
        number = {w: k for k, w in enumerate(dict.fromkeys(w for s in some for w in s))}
        words = list(number)
        features = np.empty((len(words), len(root)), np.float32)
        for k in range(0, len(words), 4096):
            features[k : k + 4096] = powered(kernel(words[k : k + 4096])) @ root
        flat = np.array([number[w] for s in some for w in s])
        x[at : at + 2048] = np.add.reduceat(features[flat], np.cumsum([0, *map(len, some)])[:-1], axis=0)
    n = len(bad)
    bad_x, good_x = x[:n], x[n:]
    score = np.array([worth.most(s) for s in bad]) - 2 * EVIDENCE
    w = None
    for _ in range(rounds):
        best = _chosen(score, owner)
        y = np.concatenate([np.ones(len(best)), -np.ones(len(good))])
        share = 1 / np.bincount(owner[best])[owner[best]]
        weight = np.concatenate([share * 100 / share.sum(), np.full(len(good), 100 / max(len(good), 1))])
        w = fit_svm(np.concatenate([bad_x[best], good_x]), y, weight, w)
        score = bad_x @ w[:-1] + w[-1]
    return (root @ w[:-1]).astype(np.float32), float(w[-1])


def one_of_each(texts: list[str]) -> list[str]:
    """Texts without near copies of earlier ones, so that a family of copies counts once: those that share under a third of their rarer words."""
    seen = Counter[str]()
    for t in texts:
        seen.update(set(t.lower().split()))
    rare = max(3, len(texts) // 50)
    held: dict[str, list[int]] = {}
    out = []
    for k, t in enumerate(texts):
        mine = [w for w in set(t.lower().split()) if seen[w] <= rare]
        shared = Counter(o for w in mine for o in held.get(w, ()))
        if mine and max(shared.values(), default=0) * 3 >= len(mine):
            continue
        out.append(t)
        for w in mine:
            if seen[w] > 1:
                held.setdefault(w, []).append(k)
    return out


def _fitted(strings: Strings, toxic: list[list[list[str]]], clean: list[list[list[str]]]) -> Model:
    """The machine of documents as sentences of shaped strings; its logistic part is still to be fitted."""
    of = lambda doc: {w for s in doc for w in s}
    toxic_sets, clean_sets = [of(d) for d in toxic], [of(d) for d in clean]
    telling = telling_runs(toxic_sets, clean_sets)
    worth = Worth(telling)
    kernel = Kernel(strings, marks := choose_landmarks(toxic_sets, clean_sets, telling, worth, LANDMARKS))
    value, vector = np.linalg.eigh(powered(kernel(marks)).astype(np.float64))
    root = (vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T).astype(np.float32)
    each = max(1, SENTENCES // max(len(toxic), 1))
    pairs = [(s, k) for k, d in enumerate(toxic) for s in sorted(d, key=worth.most, reverse=True)[:each]]
    good = [s for d in clean for s in d]
    if len(good) > SENTENCES:
        # half those that look most toxic, half as drawn
        good.sort(key=worth.most, reverse=True)
        rest = sorted(good[SENTENCES // 2 :], key=lambda s: zlib.crc32(" ".join(s).encode(), 31))
        good = good[: SENTENCES // 2] + rest[: SENTENCES // 2]
    beta, bias = fit_sentences(kernel, root, [s for s, _ in pairs], np.array([k for _, k in pairs]), good, worth)
    return Model(kernel, beta, bias, np.zeros(3))


def train(toxic: list[str], clean: list[str]) -> Model | None:
    """The model of labelled texts; None without both classes."""
    read = lambda t: [s for words in sentences(t) if (s := [x for w in words if (x := shaped(w))])]
    toxic, clean = ([t for t in one_of_each(x) if read(t)] for x in (toxic, clean))
    if not toxic or not clean:
        return None
    strings = Strings(toxic + clean)
    bad, good = [read(t) for t in toxic], [read(t) for t in clean]
    model = _fitted(strings, bad, good)
    # each part's documents are judged by a machine of the others; few documents in more parts
    features, y = [np.zeros((0, 2))], []
    least = min(len(toxic), len(clean))
    if least > 1:
        folds = min(max(2, JUDGED // least), 5, least)
        for k in range(folds):
            others = _fitted(strings, *([d for i, d in enumerate(x) if i % folds != k] for x in (bad, good)))
            features += [others.features(toxic[k::folds]), others.features(clean[k::folds])]
            y += [np.ones(len(toxic[k::folds])), -np.ones(len(clean[k::folds]))]
    else:
        features += [model.features(toxic), model.features(clean)]
        y += [np.ones(len(toxic)), -np.ones(len(clean))]
    model.logistic = fit_logistic(np.concatenate(features), np.concatenate(y))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 17) -> Model | None:
    """Train on labelled rows outside the held-out fold, at most ``sample`` documents of each class, of at most LENGTH characters."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for c in (1, 0):
        some = usable.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select("doc_id", utf8().alias("text")).where(F.length("text") <= LENGTH)
    # at most 2 * sample rows of LENGTH characters, by the limits and one text an id
    rows = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy("doc_id").collect()
    return train([r.text for r in rows if r.toxic == 1], [r.text for r in rows if r.toxic == 0])


def scored(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): one row for each input row."""
    src = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    if model is None:
        return src.select(F.col("id").alias(id_col), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.scores([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["id", "score"])

    bounded_batches(df.sparkSession)
    return src.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_toxic(df: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score under the threshold, all columns unchanged."""
    if model is None:
        return df
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.scores([t or "" for t in b.column(at).to_pylist()])
            kept = b.filter(pa.array(score < threshold))
            if kept.num_rows:
                yield kept
        # the process goes on to other work
        _WORDS.forget()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
