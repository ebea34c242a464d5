"""Language ID by a linear-chain conditional random field over words.

Every line is a sequence of words. A word's features are its affixes, its character
n-grams and the lexicons that list it; learned transitions join neighbours. Forward and
backward passes give each word's probability of each language, so text that switches
languages is labelled word by word; a document's language has the largest mean.
"""

import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces

#: The labelled sample: documents per language (about), sequences per language, words per sequence.
SAMPLE_DOCS, SAMPLE_SEQUENCES, SAMPLE_WORDS = 400, 1500, 60
LEXICON_WORDS = 400
BUCKETS = 1 << 16
EPOCHS, STEP, SEQUENCES_PER_STEP = 6, 0.3, 250
#: Words whose features a worker remembers, and words in one forward-backward pass.
REMEMBERED, PASS_WORDS = 300_000, 250_000
#: Bytes of a word, and features of some words, that are summed at a time.
BLOCK = 1 << 17

UNKNOWN = "und"
RESULT = "doc_id bigint, lang_pred string, score double"
_RESULT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def letters_of(token):
    """The token's letters in lower case; empty if it has none."""
    if token.isalpha():
        return token.lower()
    return "".join([c for c in token.lower() if c.isalpha()])


def gram_rows(padded, start, stop):
    """Rows of the byte n-grams that begin in a stretch of a padded word."""
    crc, end = zlib.crc32, len(padded)
    rows = [crc(padded[i:i + 2], 4) for i in range(start, min(stop, end - 1))]
    rows += [crc(padded[i:i + 3], 5) for i in range(start, min(stop, end - 2))]
    return [row % BUCKETS for row in rows]


def feature_rows(word, lexicons):
    """Rows of the weight table for a word: itself, affixes, byte n-grams and lexicons.

    All of the word is read. Each kind of feature starts its checksum at another value, so
    kinds do not mix.
    """
    raw = word.encode()
    return affix_rows(word, lexicons) + gram_rows(b"^" + raw + b"$", 0, len(raw) + 2)


def affix_rows(word, lexicons):
    """The rows of ``feature_rows`` without the n-grams."""
    crc, raw = zlib.crc32, word.encode()
    rows = [crc(raw, 1)]
    rows += [crc(raw[:n], 2) for n in (1, 2, 3, 4)]
    rows += [crc(raw[-n:], 3) for n in (1, 2, 3, 4)]
    rows += [crc(lang.encode(), 6) for lang, words in lexicons.items() if word in words]
    return [row % BUCKETS for row in rows]


class Model:
    """Languages, lexicons, feature weights and transition scores."""

    def __init__(self, langs, lexicons, weights, transitions):
        self.langs, self.lexicons, self.weights, self.transitions = langs, lexicons, weights, transitions

    def features(self, word):
        return feature_rows(word, self.lexicons)

    def _sums(self, rows):
        n = np.array([len(r) for r in rows])
        return np.add.reduceat(self.weights[np.concatenate(rows)], np.cumsum(n) - n)

    def _long(self, raw, word):
        """The sum for one very long word, a block of n-grams at a time."""
        padded = b"^" + raw + b"$"
        total = self.weights[affix_rows(word, self.lexicons)].sum(axis=0)
        for at in range(0, len(padded), BLOCK):
            total = total + self.weights[gram_rows(padded, at, at + BLOCK)].sum(axis=0)
        return total

    def emissions(self, words):
        """Sums of the words' weights, few features at a time however long the words are."""
        found, rows, held = [], [], 0
        for word in words:
            raw = word.encode()
            if len(raw) < BLOCK:
                rows.append(self.features(word))
                held += len(rows[-1])
            if rows and (len(raw) >= BLOCK or held >= 2 * BLOCK):
                found.append(self._sums(rows))
                rows, held = [], 0
            if len(raw) >= BLOCK:
                found.append(self._long(raw, word)[None])
        return np.concatenate(found + ([self._sums(rows)] if rows else []))


def forward_backward(emissions, lengths, transitions, want_pairs=False):
    """Posteriors of every position of many sequences laid end to end.

    Sequences are visited longest first, so that at each step the ones still running are a
    leading slice and one matrix product moves all of them.
    """
    potentials = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    running = np.searchsorted(-lengths[order], -np.arange(1, lengths.max(initial=0) + 1), side="right")
    alpha, beta = np.empty_like(potentials), np.ones_like(potentials)
    for t, n in enumerate(running):
        at = starts[:n] + t
        a = potentials[at] if t == 0 else (alpha[at - 1] @ move) * potentials[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(move)
    for t in range(len(running) - 1, 0, -1):
        at = starts[:running[t]] + t
        after = beta[at] * potentials[at]
        b = after @ move.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
        if want_pairs:
            norm = np.einsum("ni,ij,nj->n", alpha[at - 1], move, after)
            pairs += move * (alpha[at - 1].T @ (after / norm[:, None]))
    posterior = alpha * beta
    posterior /= posterior.sum(axis=1, keepdims=True)
    return (posterior, pairs) if want_pairs else posterior


def _sequences(texts_by_lang, random):
    """Labelled word sequences: lines of one language, and half of them with a second one.

    A long line gives several sequences, so that its end is as likely to be learnt from as
    its start.
    """
    lines = {}
    for label, texts in enumerate(texts_by_lang):
        own = [[w for w in map(letters_of, line.split()) if w] for text in texts for line in text.split("\n")]
        own = [x[at:at + SAMPLE_WORDS] for x in own for at in range(0, len(x), SAMPLE_WORDS)]
        picked = random.permutation(len(own))[:SAMPLE_SEQUENCES]
        lines[label] = [own[i] for i in picked]
    found = []
    for label, own in lines.items():
        for k, words in enumerate(own):
            labels = [label] * len(words)
            if k % 2 and len(lines) > 1:
                other = int(random.choice([x for x in lines if x != label and lines[x]] or [label]))
                more = lines[other][int(random.integers(len(lines[other])))] if lines[other] else []
                cut = int(random.integers(1, len(more) + 1)) if more else 0
                words, labels = words + more[:cut], labels + [other] * cut
            found.append((words, labels))
    return found


def train(rows, seed=5):
    """Fit a model to (text, lang) rows by gradient ascent on the sequences' likelihood."""
    langs = sorted({lang for _, lang in rows})
    random = np.random.default_rng(seed)
    texts = [[t for t, lang in rows if lang == own] for own in langs]
    lexicons = {
        lang: {w for w, _ in sorted(
            Counter(w for t in own for w in map(letters_of, t.split()) if w).items(), key=lambda x: (-x[1], x[0])
        )[:LEXICON_WORDS]}
        for lang, own in zip(langs, texts)
    }
    size = len(langs)
    model = Model(langs, lexicons, np.zeros((BUCKETS, size)), np.zeros((size, size)))
    sequences = _sequences(texts, random)
    known = {w: model.features(w) for words, _ in sequences for w in words}
    squares, pair_squares = np.full((BUCKETS, size), 1e-2), np.full((size, size), 1e-2)
    for _ in range(EPOCHS if size > 1 else 0):
        shuffled = random.permutation(len(sequences))
        for at in range(0, len(shuffled), SEQUENCES_PER_STEP):
            batch = [sequences[i] for i in shuffled[at:at + SEQUENCES_PER_STEP]]
            words = [w for ws, _ in batch for w in ws]
            labels = np.array([x for _, ls in batch for x in ls])
            lengths = np.array([len(ls) for _, ls in batch])
            flat = np.concatenate([known[w] for w in words])
            n = np.array([len(known[w]) for w in words])
            emissions = np.add.reduceat(model.weights[flat], np.cumsum(n) - n)
            posterior, pairs = forward_backward(emissions, lengths, model.transitions, True)
            slope = -posterior
            slope[np.arange(len(labels)), labels] += 1
            gradient = np.zeros_like(model.weights)
            for label in range(size):
                gradient[:, label] = np.bincount(flat, np.repeat(slope[:, label], n), BUCKETS)
            inner = np.ones(len(labels), bool)
            inner[np.cumsum(lengths) - lengths] = False
            steps = np.flatnonzero(inner)
            seen = np.zeros((size, size))
            np.add.at(seen, (labels[steps - 1], labels[steps]), 1)
            squares += gradient ** 2
            pair_squares += (seen - pairs) ** 2
            model.weights += STEP * gradient / np.sqrt(squares)
            model.transitions += STEP * (seen - pairs) / np.sqrt(pair_squares)
    model.weights = model.weights.astype("f4")
    return model


class Labeller:
    """Applies a model, remembering the emissions of words already seen."""

    def __init__(self, model):
        self.model = model
        self._forget()

    def _forget(self):
        self.rows, self.words, self.table = {}, {}, np.zeros((1, len(self.model.langs)))

    def posteriors(self, texts):
        """(posteriors, words per text) of the words with letters of some whole texts."""
        if len(self.rows) > REMEMBERED:
            self._forget()
        known, by_word, rows, lengths, per_text, new = self.rows, self.words, [], [], [], []
        for text in texts:
            total = 0
            for line in text.split("\n"):
                tokens = line.split()
                for t in tokens:
                    if t not in known:
                        word = letters_of(t)
                        if word and word not in by_word:  # tokens that differ in signs or case share a word
                            by_word[word] = len(self.table) + len(new)
                            new.append(word)
                        known[t] = by_word[word] if word else 0
                own = [r for r in [known[t] for t in tokens] if r]
                if own:
                    rows += own
                    lengths.append(len(own))
                    total += len(own)
            per_text.append(total)
        if new:
            self.table = np.concatenate([self.table, self.model.emissions(new)])
        if not rows:
            return np.zeros((0, len(self.model.langs))), per_text
        return forward_backward(self.table[np.array(rows)], np.array(lengths), self.model.transitions), per_text

    def label_words(self, text):
        """(token, language, probability) of every token with letters, in order."""
        posterior, _ = self.posteriors([text])
        tokens = [t for line in text.split("\n") for t in line.split() if letters_of(t)]
        best = posterior.argmax(axis=1) if len(posterior) else []
        return [(t, self.model.langs[k], float(posterior[i, k])) for i, (t, k) in enumerate(zip(tokens, best))]

    def confidence(self, texts):
        """The mean of each word's own best probability per text; None where no word has letters.

        A text in several languages, each surely labelled, is as sure as one in one language.
        """
        posterior, per_text = self.posteriors(texts)
        ends = np.cumsum(per_text, dtype=int)
        return [float(posterior[end - n:end].max(axis=1).mean()) if n else None for n, end in zip(per_text, ends)]

    def predict(self, texts):
        """(language, mean probability) per text; the unknown language where no word has letters."""
        if not self.model.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        posterior, per_text = self.posteriors(texts)
        found, at = [], 0
        for n in per_text:
            if not n:
                found.append((UNKNOWN, 0.0))
                continue
            mean = posterior[at:at + n].mean(axis=0)
            at += n
            best = int(mean.argmax())
            found.append((self.model.langs[best], float(min(1.0, mean[best]))))
        return found


def _sample_rows(docs, docs_per_lang):
    """About ``docs_per_lang`` rows of each language outside the held-out fold, None without any.

    Rows are chosen by a hash of the id against each language's own share, in one pass and
    without sorting.
    """
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_per_lang / n))]), F.col("lang")
    )
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000
    return known.filter(chosen).select("doc_id", "text", "lang").limit(2 * docs_per_lang * len(counts))


def _ordered(rows):
    """The (text, lang) rows that are learnt from, in order of their ids."""
    return [(text, lang) for _, text, lang in sorted(tuple(r) for r in rows)]


def fitted(docs, docs_per_lang=SAMPLE_DOCS):
    """The model learnt from the labelled sample, in one task; the driver gets the model only."""
    rows = _sample_rows(docs, docs_per_lang)
    if rows is None:
        return train([])

    def fit(batches):
        given = [x for batch in batches for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang")))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(_ordered(given)))], pa.binary())], names=["model"])

    return pickle.loads(rows.coalesce(1).mapInArrow(fit, "model binary").first()["model"])


def held_out():
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _passes(texts):
    """Lists of some texts, of so many characters at a time; null is empty."""
    own, held = [], 0
    for text in texts:
        own.append(text or "")
        held += len(own[-1])
        if held > 6 * PASS_WORDS:
            yield own
            own, held = [], 0
    yield own


def predict_languages(docs, model):
    """(doc_id, lang_pred, score) of every whole text.

    A text that is null or has no letter is ``und`` with score 0. Only ``text`` is read
    for a prediction.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        labeller = Labeller(shared.value)
        for batch in pieces(batches):
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            found = [x for own in _passes(texts) for x in labeller.predict(own)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                schema=_RESULT,
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, RESULT)


def keep_languages(docs, model, least_score):
    """Rows of ``docs`` whose words have a language with at least this mean probability.

    What counts is how sure each word is of its own language, not the share of the largest
    one: texts that switch languages stay. A text without letters goes; all texts stay where
    nothing could be learnt. Nothing is shuffled.
    """
    if not model.langs:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        labeller = Labeller(shared.value)
        for batch in pieces(batches):
            found = [x for own in _passes(batch.column("text").to_pylist()) for x in labeller.confidence(own)]
            yield batch.filter(pa.array([x is not None and x >= least_score for x in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def language_id(docs):
    """Learn from the labelled documents outside the held-out fold and predict all."""
    return predict_languages(docs, fitted(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
