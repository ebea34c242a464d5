"""Secret scans: base patterns, and a character convolutional network over every candidate.

Candidates are proposed freely: every run of characters that secrets are made of, with its
surroundings. The network sees windows of characters, with the candidate's own marked; a long
candidate is seen in overlapping windows, of which the best counts. It is trained on labelled
findings: what base patterns cover, the same under other names and in other alphabets, and as
clean ones free candidates, names, paths and numbers. Its scores are calibrated on findings
held out of training, and the threshold of a kind keeps the wanted share of them; the
precision that this costs is kept beside it.
"""

import hashlib
import random
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import pieces, staged

KINDS = ("assign", "access", "hex")
#: The base patterns; a match must be as long as LEAST says, in group GROUP.
BASE = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{32,}"),
}
GROUP = {"assign": 2, "access": 0, "hex": 0}
LEAST = {"assign": 8, "access": 16, "hex": 32}
HINTS = ("pass", "secret", "token", "api")

#: A candidate: a run of these characters that has a digit or capitals inside.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{8,}(?:={1,2}(?![A-Za-z0-9]))?")
_MIXED = re.compile(r"[0-9+/=_]|[a-z][A-Z]|[A-Z]{2}")
#: What stands before a value that is given a name: free candidates there are not learnt as clean.
_NAMED = re.compile(r"""[:=]\x20*["']?$""")
#: Characters of context on each side, of candidate shown, of the whole window, between windows.
CONTEXT, SHOWN, SLIDE = 24, 48, 24
WINDOW = 2 * CONTEXT + SHOWN

# How secrets are named and how other things are, alphabets of secrets.
SECRET_NAMES = ("pwd=", "pass: ", "auth_key = \"", "credentials: ", "private_key=", "client_secret_id: ", "https://admin:")
OTHER_NAMES = ("title: ", "name=", "page = \"", "see ", "https://www.", "order no. ", "version ")
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
)
#: Secrets as short as LEAST_NAMED are learnt after a name only, longer than LEAST_BARE without one too.
LEAST_NAMED, LEAST_BARE, LONGEST = 8, 24, 64

FILTERS, WIDTH = 24, 5
EPOCHS, BATCH, STEP = 12, 64, 0.01
#: Documents the labelled findings come from (about), and findings of a label used.
SAMPLE_DOCS, SAMPLE_FINDINGS = 20_000, 3_000
#: Share of held-out findings that the threshold of a kind must keep.
RECALL = 0.95


def _char_classes():
    """Class of each byte: digits and letters by themselves, signs by themselves, the rest one."""
    own = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-.:\"' \n"
    table = np.ones(256, "u1")
    for k, c in enumerate(own):
        table[ord(c)] = k + 2
    return table, len(own) + 2


_CLASS, N_CLASSES = _char_classes()


def base_spans(text):
    """(kind, start, end) of the base findings: leftmost, not overlapping within a kind."""
    found = []
    lowered = text.lower()
    for kind, pattern in BASE.items():
        if kind == "assign" and not any(h in lowered for h in HINTS):
            continue
        for m in pattern.finditer(text):
            if m.end(GROUP[kind]) - m.start(GROUP[kind]) >= LEAST[kind]:
                found.append((kind, m.start(), m.end()))
    return found


def candidates(text):
    """(start, end) of every candidate."""
    return [m.span() for m in CANDIDATE.finditer(text) if _MIXED.search(m.group())]


def kind_of(value):
    """The kind that a candidate is like."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return "hex"
    return "access" if re.fullmatch(r"[A-Z0-9]+", value) else "assign"


def free_of(spans, taken):
    """Spans that touch none of ``taken``, in one sweep over both in order."""
    merged = []
    for start, end in sorted(taken):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    ends = [end for _, end in merged]

    def touched(start, end):
        at = bisect_left(ends, start + 1)
        return at < len(merged) and merged[at][0] < end

    return [x for x in spans if not touched(*x)]


def _views(start, end):
    """Starts of the windows that together show a whole candidate."""
    last = max(start, end - SHOWN)
    return [*range(start, last, SLIDE), last]


def windows(text, spans):
    """Rows of character classes around candidates, a mask of their own characters, and the
    row at which each candidate starts: a long candidate has several."""
    views = [[(at, start, end) for at in _views(start, end)] for start, end in spans]
    firsts = np.cumsum([0, *(len(v) for v in views)])[:-1]
    rows = [v for found in views for v in found]
    chars = np.zeros((len(rows), WINDOW), "u1")
    own = np.zeros((len(rows), WINDOW), "f4")
    for row, (at, start, end) in enumerate(rows):
        before, shown = text[max(0, at - CONTEXT):at], text[at:min(end, at + SHOWN)]
        after = text[at + len(shown):at + len(shown) + CONTEXT]
        for place, piece in ((CONTEXT - len(before), before), (CONTEXT, shown), (CONTEXT + SHOWN, after)):
            raw = np.frombuffer(piece.encode("latin-1", "replace"), "u1")
            chars[row, place:place + len(raw)] = _CLASS[raw]
        own[row, CONTEXT:CONTEXT + len(shown)] = 1
    return chars, own, firsts


class Network:
    """One convolution over characters, the strongest answer of each filter, a logistic unit.

    The convolution of one-hot characters is a sum of table rows, so a window needs WIDTH
    lookups and no product.
    """

    def __init__(self, seed=7):
        random = np.random.default_rng(seed)
        self.tables = random.normal(0, 0.1, (WIDTH, N_CLASSES, FILTERS)).astype("f4")
        self.mark = random.normal(0, 0.1, (WIDTH, FILTERS)).astype("f4")
        self.bias = np.zeros(FILTERS, "f4")
        self.out = random.normal(0, 0.1, 2 * FILTERS).astype("f4")
        self.shift = np.zeros(1, "f4")
        self.slope, self.offset = 1.0, 0.0
        self.thresholds, self.precision = {}, {}

    def _conv(self, chars, own):
        n = WINDOW - WIDTH + 1
        total = np.zeros((len(chars), n, FILTERS), "f4") + self.bias
        for k in range(WIDTH):
            total += self.tables[k][chars[:, k:k + n]] + own[:, k:k + n, None] * self.mark[k]
        return total

    def _pooled(self, hidden):
        best = hidden.argmax(axis=1)
        top = np.take_along_axis(hidden, best[:, None], 1)[:, 0]
        return best, np.concatenate([np.maximum(top, 0), np.maximum(hidden, 0).mean(axis=1)], axis=1)

    def margins(self, chars, own):
        found = [self._pooled(self._conv(chars[at:at + 256], own[at:at + 256]))[1] @ self.out + self.shift
                 for at in range(0, len(chars), 256)]
        return np.concatenate(found) if found else np.zeros(0, "f4")

    def probabilities(self, chars, own):
        return 1 / (1 + np.exp(-(self.slope * self.margins(chars, own) + self.offset)))

    def best(self, text, spans):
        """The probability of each candidate: that of its best window."""
        if not spans:
            return np.zeros(0, "f4")
        chars, own, firsts = windows(text, spans)
        return np.maximum.reduceat(self.probabilities(chars, own), firsts)

    def fit(self, chars, own, labels, seed=7):
        """Adam on the logistic loss, both labels weighing the same."""
        weights = _balance(labels)
        random, n = np.random.default_rng(seed), WINDOW - WIDTH + 1
        names = ("tables", "mark", "bias", "out", "shift")
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        step = 0
        for _ in range(EPOCHS):
            order = random.permutation(len(labels))
            for at in range(0, len(order), BATCH):
                pick = order[at:at + BATCH]
                c, o = chars[pick], own[pick]
                hidden = self._conv(c, o)
                best, pooled = self._pooled(hidden)
                error = (1 / (1 + np.exp(-(pooled @ self.out + self.shift))) - labels[pick]) * weights[pick] / len(pick)
                back = np.outer(error, self.out).astype("f4")
                flow = (hidden > 0) * (back[:, None, FILTERS:] / n)
                rows, cols = np.arange(len(pick))[:, None], np.arange(FILTERS)
                flow[rows, best, cols] += back[:, :FILTERS] * (hidden[rows, best, cols] > 0)
                slopes = {"out": pooled.T @ error, "shift": error.sum(keepdims=True), "bias": flow.sum(axis=(0, 1)),
                          "mark": np.stack([np.einsum("bn,bnf->f", o[:, k:k + n], flow) for k in range(WIDTH)])}
                tables = np.zeros_like(self.tables)
                flat = flow.reshape(-1, FILTERS)
                for k in range(WIDTH):
                    hot = np.zeros((N_CLASSES, len(flat)), "f4")
                    hot[c[:, k:k + n].ravel(), np.arange(len(flat))] = 1
                    tables[k] = hot @ flat
                slopes["tables"] = tables
                step += 1
                for k in names:
                    g = slopes[k].astype("f4")
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    change = STEP * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                    setattr(self, k, getattr(self, k) - change)
        return self

    def calibrate(self, chars, own, labels, kinds, recall=RECALL):
        """Fit probabilities to held-out findings; the threshold of a kind keeps ``recall`` of them.

        Where that lies above all clean ones, the threshold is halfway between the two margins.
        A kind without held-out findings gets no threshold, and nothing is added for it.
        """
        margins, weights = self.margins(chars, own), _balance(labels)
        for _ in range(200):  # logistic regression on the margin
            p = 1 / (1 + np.exp(-(self.slope * margins + self.offset)))
            self.slope -= 0.5 * float(((p - labels) * margins * weights).mean())
            self.offset -= 0.5 * float(((p - labels) * weights).mean())
        scores, kinds = self.probabilities(chars, own), np.asarray(kinds)
        for kind in KINDS:
            right = np.sort(scores[(kinds == kind) & (labels == 1)])
            if len(right):
                least, wrong = float(right[int((1 - recall) * len(right))]), scores[(kinds == kind) & (labels == 0)]
                if len(wrong) and wrong.max() < least:
                    least = float(_between(least, wrong.max()))
                kept = (right >= least).mean()
                passed = (wrong >= least).mean() if len(wrong) else 0.0
                self.thresholds[kind], self.precision[kind] = least, float(kept / (kept + passed))
        return self


def _between(a, b):
    """The probability whose margin is halfway between those of two others."""
    low, high = (np.log(x / (1 - x)) for x in np.clip([a, b], 1e-7, 1 - 1e-7))
    return 1 / (1 + np.exp(-(low + high) / 2))


def _balance(labels):
    """Weights under which both labels count the same."""
    share = max(float(labels.mean()), 1e-6)
    return np.where(labels == 1, 0.5 / share, 0.5 / max(1 - share, 1e-6)).astype("f4")


def train(findings, seed=7):
    """A network from labelled findings (text around, start, end, label, origin); None if one-sided.

    A fifth of the findings, by a hash of the value, is held out for calibration.
    """
    if len({x[3] for x in findings}) < 2:
        return None
    parts = [windows(text, [(start, end)]) for text, start, end, *_ in findings]
    sizes = [len(part[0]) for part in parts]
    chars, own = (np.concatenate([part[k] for part in parts]) for k in (0, 1))
    values = [text[start:end] for text, start, end, *_ in findings]
    labels = np.repeat(np.array([x[3] for x in findings], "f4"), sizes)
    held = np.repeat([hashlib.md5(v.encode()).digest()[0] % 5 == 0 for v in values], sizes)
    kinds = np.repeat([kind_of(v) for v in values], sizes)
    if len(set(labels[~held])) < 2:
        return None
    network = Network(seed).fit(chars[~held], own[~held], labels[~held], seed)
    return network.calibrate(chars[held], own[held], labels[held], kinds[held]) if held.any() else network


def _around(text, start, end, label, origin):
    low = max(0, start - CONTEXT)
    return (text[low:end + CONTEXT], start - low, end - low, label, origin)


def _words(text):
    return re.findall(r"[^\W\d_]{2,12}", text)[:400] or ["-"]


def _framed(value, name, words, label, rng):
    """A value among words of its text; both labels get the same frames, so only names differ."""
    before = " ".join(rng.choice(words) for _ in range(4)) + rng.choice((" ", " ", ". ", "\n", " (", ": "))
    close = '"' if name.endswith('"') else "@" if name.startswith("https://admin") else rng.choice(("", "", "", ".", ",", '"', ")"))
    whole = before + name + value + close + " " + " ".join(rng.choice(words) for _ in range(4))
    at = len(before) + len(name)
    fits = CANDIDATE.fullmatch(value) and _MIXED.search(value)
    return [_around(whole, at, at + len(value), label, "rewritten")] if fits else []


def _rewritten(words, rng):
    """A finding under other names and in other alphabets: secrets all of them."""
    rows = []
    for alphabet in ALPHABETS:
        for name in (rng.choice(SECRET_NAMES), ""):
            size = rng.randint(LEAST_NAMED if name else LEAST_BARE, LONGEST)
            rows += _framed("".join(rng.choice(alphabet) for _ in range(size)), name, words, 1.0, rng)
    return rows


def _plain(text, rng):
    """Names, paths, numbers and dates made of a text's own words: no secrets."""
    words = re.findall(r"[A-Za-z]{3,12}", text)[:400]
    if len(words) < 8:
        return []
    pick = lambda: [rng.choice(words) for _ in range(rng.randint(2, 5))]
    made = [
        "_".join(pick()), "/".join(pick()), "".join(w.capitalize() for w in pick()), "-".join(pick()) + str(rng.randint(1, 2030)),
        str(rng.randint(10**7, 10**19)), f"{rng.randint(1900, 2100)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        "".join(pick()).upper(), "".join(pick()) + str(rng.randint(1, 999)),
    ]
    frame = _words(text)
    return [row for value in rng.sample(made, 2) for name in (rng.choice(OTHER_NAMES), "")
            for row in _framed(value, name, frame, 0.0, rng)]


def _unclear(text, start, end):
    """Whether a free candidate may be a secret: it has a name, or is long and changes often
    between digits, small letters and capitals."""
    value = text[start:end]
    classes = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "" for c in value]
    changes = sum(a != b for a, b in zip(classes, classes[1:]) if a and b)
    return (len(value) >= LEAST_BARE and 5 * changes >= len(value)) or bool(_NAMED.search(text[max(0, start - CONTEXT):start]))


def label_findings(text):
    """Labelled candidates of one text: (text around, start, end, label, origin).

    Secrets are what base findings cover; they come back with the words before them blanked
    and rewritten, so that the network learns more than the base patterns. Clean ones are
    free candidates and things made of the text's words; free candidates that may be secrets
    are left out.
    """
    base = [(s, e) for _, s, e in base_spans(text)]
    proposed = candidates(text)
    free = set(free_of(proposed, base))
    rng = random.Random(hashlib.md5(text.encode("utf-8", "replace")).digest())
    rows = _plain(text, rng)
    for start, end in proposed:
        if (start, end) in free:
            if not _unclear(text, start, end):
                rows.append(_around(text, start, end, 0.0, "found"))
            continue
        around, at, stop, *_ = _around(text, start, end, 1.0, "found")
        rows += [(around, at, stop, 1.0, "found"), (" " * at + around[at:stop] + around[stop:].lstrip("\"'"), at, stop, 1.0, "found")]
        rows += _rewritten(_words(text), rng)
    return rows


def labelled_findings(docs, size=SAMPLE_DOCS, limit=SAMPLE_FINDINGS):
    """At most ``limit`` findings of each label and origin, from about ``size`` documents.

    Repeated findings count once; those with the smallest hashes are taken, ties by their text.
    """
    total = docs.count()
    share = int(min(1.0, size / max(1, total)) * 1_000_000)
    chosen = docs.filter(F.col("text").isNotNull()).filter(
        F.pmod(F.xxhash64("doc_id", F.lit("secrets")), F.lit(1_000_000)) < share
    ).select("text")

    def label(batches):
        for batch in batches:
            rows = [r for t in batch.column("text").to_pylist() for r in label_findings(t)]
            columns = zip(*rows) if rows else [()] * 5
            types = (pa.string(), pa.int32(), pa.int32(), pa.float32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["around", "start", "end", "label", "origin"]
            )

    schema = "around string, start int, end int, label float, origin string"
    rows = staged(chosen.mapInArrow(label, schema).dropDuplicates(), "secret-findings")
    found = []
    for value in (0.0, 1.0):
        for origin in ("found", "rewritten"):
            own = rows.filter((F.col("label") == value) & (F.col("origin") == origin))
            own = own.orderBy(F.xxhash64("around", "start"), "around", "start", "end").limit(limit)
            found += [tuple(r[c] for c in rows.columns) for r in own.collect()]
    return found


RESULT = "doc_id bigint, base array<struct<kind:string,start:bigint,end:bigint>>, spans array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_RESULT = pa.schema([("doc_id", pa.int64()), ("base", _SPAN), ("spans", _SPAN)])


def in_order(spans):
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan_text(text, network):
    """(base spans, all spans) of one text, by start and then kind.

    A candidate that no base span touches is added under the kind it is like, if the
    network's probability reaches the threshold of that kind.
    """
    base = base_spans(text)
    added = []
    if network is not None:
        free = free_of(candidates(text), [(s, e) for _, s, e in base])
        for (s, e), p in zip(free, network.best(text, free)):
            kind = kind_of(text[s:e])
            if p >= network.thresholds.get(kind, 2):
                added.append((kind, s, e))
    return in_order(base), in_order(base + added)


def find_secrets(docs, network):
    """(doc_id, base, spans): arrays of (kind, start, end) in code points, end exclusive.

    A null text is empty, repeated rows each give a row, columns other than doc_id and text
    are not read. Every candidate of every whole text is scored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def scan(batches):
        for batch in pieces(batches):
            found = [scan_text(t or "", shared.value) for t in batch.column("text").to_pylist()]
            sides = [[[dict(zip(("kind", "start", "end"), x)) for x in f[side]] for f in found] for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, _SPAN) for x in sides)], schema=_RESULT
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, RESULT)


def joined(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secret_report(docs):
    """The digest per document: counts, the base spans' hash, all spans as text and their number."""
    network = train(labelled_findings(docs))
    return find_secrets(docs, network).select(
        "doc_id",
        *(F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
