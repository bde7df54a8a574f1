"""Language of texts, word by word, with a linear-chain conditional random field.

Words of scripts without spaces are cut into short pieces first. A word is described by its affixes, its byte n-grams and how often it occurs in each language (the lexicon). The field adds
learned weights of transitions, and forward-backward gives each word's probability of each language, given the words
around it. A text's language is the one with the largest sum over its words.

The weights are fitted on the driver to a bounded sample of labelled texts (``sample_docs`` per language, ``segments`` windows in
all, more where there are more than 125 languages); half of the windows join text of two languages, so that transitions are learned from switches too. The lexicon's words are
the frequent ones of the sample; their counts are taken over all labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motorlytics.llm.common import batch, slices, table
from motorlytics.session import written

SAMPLE_DOCS = 300
LEXICON_WORDS = 3000
SEGMENTS = 8000
WINDOW = 32
FEATURE_BITS = 15
EPOCHS = 6
KNOWN_WORDS = 300_000
STRAND = 1024
PRECISION = 1e-6
SCORE_BYTES = 1 << 15
# Up to this many labels have the sample, lexicon and windows above; with more of them each has a smaller share, so that the
# driver's work follows the labels, but never less than the least. Every label is learned.
FULL_LABELS = 32
LEAST_DOCS, LEAST_WORDS, LEAST_SEGMENTS = 30, 100, 64
# Characters of scripts without spaces between words, and how many make a piece.
IDEOGRAPHS = "\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
BRAHMIC = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u19e0-\u19ff\ua9e0-\ua9ff\uaa60-\uaa7f"
_UNSPACED = re.compile(f"[{IDEOGRAPHS}{BRAHMIC}]")
_PIECES = re.compile(f"[{IDEOGRAPHS}]{{1,2}}|[{BRAHMIC}]{{1,5}}|[^{IDEOGRAPHS}{BRAHMIC}]+")
_UNSPACED_BYTES = re.compile(b"[\xe0-\xf4]")  # first bytes of characters of three and four bytes

# ASCII letters in lower case and all other characters above ASCII make words.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The words of a text in lower case; empty if it has no letter."""
    found = text.lower().encode().translate(_LETTERS).split()
    if found and not any(w.isascii() or any(c.isalpha() for c in w.decode()) for w in found):
        return []
    return found


def pieces_of(words: list[bytes]) -> list[bytes]:
    """The words with those of unspaced scripts cut into short pieces, each about as much text as a word of other scripts."""
    if not any(map(_UNSPACED_BYTES.search, words)):
        return words
    out: list[bytes] = []
    for w in words:
        if _UNSPACED_BYTES.search(w) and _UNSPACED.search(text := w.decode()):
            out += [p.encode() for p in _PIECES.findall(text) if any(c.isalpha() for c in p)] or [w]
        else:
            out.append(w)
    return out


def described(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the features of all words in a row, and how many each has: prefixes and suffixes of 1 to 3 bytes, then bi- and
    trigrams with the word's ends, over the whole word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    head = np.array([w[:3] for w in words], "S3").view(np.uint8).reshape(len(words), 3).astype(np.uint64)
    tail = np.array([w[:-4:-1] for w in words], "S3").view(np.uint8).reshape(len(words), 3).astype(np.uint64)
    ends = [x for y in (head, tail) for x in (y[:, 0], y[:, 0] << 8 | y[:, 1], y[:, 0] << 16 | y[:, 1] << 8 | y[:, 2])]
    raw = np.frombuffer(b"".join(b"\0" + w + b"\0\0" for w in words), np.uint8).astype(np.uint64)
    first = np.cumsum(sizes + 3) - (sizes + 3)
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    at = np.arange(len(owner)) + 2 * owner  # the size + 1 places of each word in ``raw``
    two = raw[at] << 8 | raw[at + 1]
    three = two << 8 | raw[at + 2]
    counts = 2 * (sizes + 1) + len(ends)
    start = np.cumsum(counts) - counts
    codes = np.empty(int(counts.sum()), np.uint64)
    for k, x in enumerate(ends):
        codes[start + k] = x | np.uint64((1 + k) << 32)
    place = start[owner] + len(ends) + at - first[owner]
    codes[place] = two | np.uint64(7 << 32)
    codes[place + sizes[owner] + 1] = three | np.uint64(8 << 32)
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64), counts


def summed(weights: np.ndarray, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the weights of each word's features."""
    return np.add.reduceat(weights[features], np.cumsum(counts) - counts, axis=0)


@dataclass
class Field:
    """A fitted field: weights of features, of the lexicon, and of transitions. ``langs`` gives the order of labels."""

    langs: list[str]
    lexicon: dict[bytes, np.ndarray]
    weights: np.ndarray
    lexical: np.ndarray
    steps: np.ndarray

    def lexical_scores(self, words: list[bytes]) -> np.ndarray:
        none = np.zeros(len(self.langs), np.float32)
        return np.array([self.lexicon.get(w, none) for w in words], np.float32).reshape(len(words), len(self.langs))

    def scores(self, words: list[bytes]) -> np.ndarray:
        """The weight of each label for each word, before its neighbours count."""
        out = [summed(self.weights, *described(words[a:b])) for a, b in slices(words, SCORE_BYTES)]
        return np.concatenate(out) + self.lexical * self.lexical_scores(words)


def marginals(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over windows at once: scores are (windows, words, labels), padded after ``lengths``.

    Returns each word's label probabilities, the forward and the scaled backward vectors.
    """
    n, size, labels = scores.shape
    own = np.exp(scores - scores.max(2, keepdims=True))
    moves = np.exp(steps - steps.max())
    forward, backward = np.empty_like(own), np.ones_like(own)
    forward[:, 0] = own[:, 0] / own[:, 0].sum(1, keepdims=True)
    for t in range(1, size):
        a = (forward[:, t - 1] @ moves) * own[:, t]
        forward[:, t] = a / a.sum(1, keepdims=True)
    for t in range(size - 2, -1, -1):
        b = (backward[:, t + 1] * own[:, t + 1]) @ moves.T
        b /= b.sum(1, keepdims=True)
        backward[:, t] = np.where((t + 1 < lengths)[:, None], b, 1)
    both = forward * backward
    return both / both.sum(2, keepdims=True), forward, backward * own


def reach(steps: np.ndarray, precision: float = PRECISION) -> int:
    """After how many words the field has forgotten where it came from, to a relative error of ``precision``.

    With d the largest difference of two rows' log ratios, a step brings any two vectors closer by tanh(d / 4) in Hilbert's
    metric, whatever the words are, and no two are further apart than d after the first step.
    """
    far = max(float(np.ptp(steps - row, axis=1).max()) for row in steps)
    closer = np.tanh(far / 4)
    return 1 if far <= precision else 1 + max(1, int(np.ceil(np.log(precision / far) / np.log(min(closer, 1 - 1e-9)))))


def whole_marginals(scores: np.ndarray, sizes: np.ndarray, steps: np.ndarray, strand: int = STRAND) -> np.ndarray:
    """Each word's label probabilities by forward-backward over whole texts; ``scores`` has the words of all, ``sizes`` how many each has.

    Texts of up to ``strand`` words go in one piece. Longer ones are cut into strands that also run over the words around
    them, as many as the field remembers (``reach``), so transitions count across all cuts. Strands advance together, the
    longest first, so that those which go on lie side by side at every step and nothing is padded.
    """
    lap = reach(steps)
    strand = max(strand, 4 * lap)
    cuts = -(-sizes // strand)
    text = np.repeat(np.arange(len(sizes)), cuts)
    begin = strand * (np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
    end = np.minimum(begin + strand, sizes[text])
    low, high = np.maximum(begin - lap, 0), np.minimum(end + lap, sizes[text])
    order = np.argsort(low - high, kind="stable")
    length, first = (high - low)[order], ((np.cumsum(sizes) - sizes)[text] + low)[order]
    kept_from, kept_to = (begin - low)[order], (end - low)[order]
    alive = np.cumsum(np.bincount(length)[::-1])[::-1][1:]
    at = np.cumsum(alive) - alive
    rank = np.repeat(np.arange(len(length)), length)
    step = np.arange(len(rank)) - np.repeat(np.cumsum(length) - length, length)
    place, word = at[step] + rank, first[rank] + step
    own = np.empty((len(word), scores.shape[1]), scores.dtype)
    own[place] = scores[word]
    own = np.exp(own - own.max(1, keepdims=True))
    moves = np.exp(steps - steps.max())
    forward, backward = np.empty_like(own), np.ones_like(own)
    forward[: alive[0]] = own[: alive[0]] / own[: alive[0]].sum(1, keepdims=True)
    spans = list(zip(at[:-1].tolist(), at[1:].tolist(), alive[1:].tolist()))
    for a, b, n in spans:
        x = (forward[a : a + n] @ moves) * own[b : b + n]
        forward[b : b + n] = x / x.sum(1, keepdims=True)
    for a, b, n in reversed(spans):
        x = (backward[b : b + n] * own[b : b + n]) @ moves.T
        backward[a : a + n] = x / x.sum(1, keepdims=True)
    both = forward * backward
    both /= both.sum(1, keepdims=True)
    kept = (step >= kept_from[rank]) & (step < kept_to[rank])
    found = np.empty_like(scores)
    found[word[kept]] = both[place[kept]]
    return found


def windows_of(samples: list[tuple[int, list[bytes]]], n: int, rng: np.random.Generator) -> list[tuple[list[bytes], np.ndarray]]:
    """Windows of words with their labels, the labels in turn; every second one goes on in a text of another label."""
    by_label: dict[int, list[list[bytes]]] = {}
    for label, words in samples:
        if words:
            by_label.setdefault(label, []).append(words)
    made, present = [], sorted(by_label)
    for i in range(n if present else 0):
        parts, size = [present[i % len(present)]], [WINDOW]
        if i // len(present) % 2 and len(present) > 1:
            parts.append(present[(i + 1 + int(rng.integers(len(present) - 1))) % len(present)])
            size = [int(rng.integers(4, WINDOW - 4))]
            size.append(WINDOW - size[0])
        words, labels = [], []
        for label, length in zip(parts, size):
            text = by_label[label][int(rng.integers(len(by_label[label])))]
            start = int(rng.integers(max(1, len(text) - length + 1)))
            words += text[start : start + length]
            labels += [label] * (len(words) - len(labels))
        made.append((words, np.array(labels)))
    return made


def fitted(langs: list[str], samples: list[tuple[int, list[bytes]]], lexicon: dict[bytes, np.ndarray], segments: int = SEGMENTS,
           epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by adaptive gradient steps over small batches of windows, with weights shrunk a little."""
    rng, k = np.random.default_rng(7), len(langs)
    field = Field(langs, lexicon, np.zeros((1 << FEATURE_BITS, k), np.float32), np.ones(k, np.float32), np.zeros((k, k), np.float32))
    windows = windows_of(samples, segments, rng)
    squares = [np.full_like(x, 1e-3) for x in (field.weights, field.lexical, field.steps)]
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for low in range(0, len(order), 256):
            some = [windows[i] for i in order[low : low + 256]]
            lengths = np.array([len(w) for w, _ in some])
            types = {w: i for i, w in enumerate(dict.fromkeys(w for words, _ in some for w in words))}
            (features, counts), lexical = described(list(types)), field.lexical_scores(list(types))
            per_type = summed(field.weights, features, counts) + field.lexical * lexical
            at, gold = np.zeros((len(some), WINDOW), np.int64), np.zeros((len(some), WINDOW), np.int64)
            for i, (words, labels) in enumerate(some):
                at[i, : len(words)] = [types[w] for w in words]
                gold[i, : len(words)] = labels
            there = np.arange(WINDOW) < lengths[:, None]
            scores = np.where(there[:, :, None], per_type[at], 0).astype(np.float32)
            found, forward, onward = marginals(scores, lengths, field.steps)
            error = np.where(there[:, :, None], np.eye(k, dtype=np.float32)[gold] - found, 0)
            by_type = np.stack([np.bincount(at.ravel(), error[:, :, c].ravel(), len(types)) for c in range(k)], 1)
            gradient = np.stack([np.bincount(features, np.repeat(by_type[:, c], counts), len(field.weights)) for c in range(k)], 1)
            pairs = there[:, 1:]
            moves = np.exp(field.steps - field.steps.max())
            before, after = forward[:, :-1][pairs], onward[:, 1:][pairs]
            joint = moves * ((before / ((before @ moves) * after).sum(1, keepdims=True)).T @ after)
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
            for x, g, q in zip((field.weights, field.lexical, field.steps),
                               (gradient, (by_type * lexical).sum(0), seen - joint), squares):
                g = (g / len(some) - 1e-5 * x).astype(np.float32)
                q += g * g
                x += 0.2 * g / np.sqrt(q)
    return field


# --- Spark ---


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4


def _lexicon(train: DataFrame, langs: list[str], candidates: list[bytes]) -> dict[bytes, np.ndarray]:
    """Log shares of each candidate word among all labelled texts' words of each language, centred."""
    schema = pa.schema([("label", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
    wanted, number = frozenset(candidates), {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}
        for rows in batches:
            for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                if lang in number:
                    found = Counter(pieces_of(words_of(text)))
                    counts.setdefault(number[lang], Counter()).update({w: n for w, n in found.items() if w in wanted} | {b"": found.total()})
        for label, found in counts.items():
            yield batch(schema, [[label] * len(found), list(found), list(found.values())])

    rows = train.select("lang", "text").mapInArrow(run, "label int, word binary, n long").groupBy("label", "word").agg(F.sum("n").alias("n"))
    counts = {w: np.zeros(len(langs), np.float32 if w else float) for w in [b"", *candidates]}
    for label, word, n in rows.toLocalIterator():  # as many as candidates times languages at most
        counts[bytes(word)][label] = n
    total = np.maximum(counts.pop(b""), 1)
    logs = {w: np.log((c + 0.5) / total * 1e6) for w, c in counts.items()}
    return {w: (x - x.mean()).astype(np.float32) for w, x in logs.items()}


def train_field(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, lexicon_words: int = LEXICON_WORDS,
                segments: int = SEGMENTS) -> Field | None:
    """A field for every label of ``docs`` (``lang``, ``text``); None if no text has a label.

    The draw of a label follows the number of its distinct texts, so copies don't thin the sample.
    """
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sizes = written(train.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.05).alias("texts")), "label-sizes")
    langs = sorted(r["lang"] for r in sizes.select("lang").collect())
    if not langs:
        return None
    over = (FULL_LABELS / max(FULL_LABELS, len(langs)))
    sample_docs = min(sample_docs, max(LEAST_DOCS, int(sample_docs * over)))
    lexicon_words = min(lexicon_words, max(LEAST_WORDS, int(lexicon_words * over * over)))
    segments = max(segments, LEAST_SEGMENTS * len(langs))
    share = F.least(F.lit(1.0), F.lit(2.0 * sample_docs) / F.col("texts"))
    hashed = train.withColumn("h", F.xxhash64("text")).join(F.broadcast(sizes), "lang")  # a row per label
    drawn = hashed.where(F.pmod("h", F.lit(1 << 32)) <= share * float(1 << 32)).select("lang", "h", "text").dropDuplicates(["lang", "h"])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = drawn.withColumn("r", first).where(F.col("r") <= sample_docs).orderBy("lang", "h").collect()
    number = {x: i for i, x in enumerate(langs)}
    samples = [(number[r["lang"]], pieces_of(words_of(r["text"]))) for r in sample]
    found = [Counter() for _ in langs]
    for label, words in samples:
        found[label].update(words)
    candidates: dict[bytes, None] = {}
    for each in found:
        candidates.update(dict.fromkeys(w for w, _ in sorted(each.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]))
    return fitted(langs, samples, _lexicon(train, langs, list(candidates)), segments)


def predict(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (the label's share of the words), ``n_words``, ``shares`` (by label) and ``n_switches``.

    ``und`` with score 0 if a text is null or has no letter, or without a field. Labels of words come from forward-backward over
    the whole text; all its words count, and words of unspaced scripts by their pieces (``n_words`` has them whole). Null ids and repeated rows stay; an empty table gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()),
                        ("shares", pa.list_(pa.float64())), ("n_switches", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def of_texts(model: Field, texts: list[list[bytes]], known: dict, table: list) -> tuple[np.ndarray, np.ndarray]:
        flat = [w for words in texts for w in words]
        fresh = [w for w in dict.fromkeys(flat) if w not in known]
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            table.append(model.scores(fresh))
            table[:] = [np.concatenate(table)]
        at = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
        sizes = np.array([len(t) for t in texts])
        found = whole_marginals(table[0][at], sizes, model.steps)
        owner = np.repeat(np.arange(len(texts)), sizes)
        labels = found.argmax(1)
        switches = np.bincount(owner[1:], (labels[1:] != labels[:-1]) & (owner[1:] == owner[:-1]), len(texts))
        return np.stack([np.bincount(owner, found[:, c], len(texts)) for c in range(found.shape[1])], 1) / sizes[:, None], switches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known, scores = {}, []
        limit = (1 << 24) // max(8, len(model.langs)) if model else 1
        for rows in batches:
            texts = [words_of(t) if t and model else [] for t in rows.column(1).to_pylist()]
            out = [("und", 0.0, len(t), None, 0) for t in texts]
            pieces = [pieces_of(t) for t in texts]
            some = [i for i, t in enumerate(texts) if t]
            for a, b in slices([range(8 * len(pieces[i])) for i in some], limit):
                if len(known) > KNOWN_WORDS:
                    known, scores = {}, []
                shares, switches = of_texts(model, [pieces[i] for i in some[a:b]], known, scores)
                for i, share, n in zip(some[a:b], shares, switches):
                    best = int(share.argmax())
                    out[i] = (model.langs[best], min(1.0, float(share[best])), len(texts[i]), share.tolist(), int(n))
            yield batch(schema, [rows.column(0), *zip(*out)] if out else [rows.column(0), [], [], [], [], []])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, lang_pred string, score double, n_words long, shares array<double>, n_switches long")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = train_field(docs.where(fold_of(F.col("doc_id")) != 2))
    held_out = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return predict(docs, field).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
