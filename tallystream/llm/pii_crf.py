"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. The field labels the tokens of a document that hold
a digit or an ``@``: its nodes are these tokens, chain edges join neighbours, and
skip edges join distant tokens that are equal or alike (same digits, same text
without case and outer signs, same mail domain), each to the one before, so that
their labels agree. Tokens of base spans are observed. Loopy sum-product message
passing gives every token's label; runs of tokens with one label that touch no
base span are added. The field is trained by pseudo-likelihood on the patterns'
labels of a bounded sample of documents.

Offsets are code points, ends exclusive. Null and empty texts have no spans.
Repeated documents each get a row. Without documents to train on nothing is
added. Very long texts are labelled whole; ``converged`` says whether a text's messages
came to rest. Only documents of up to ``SAMPLE_TOKENS`` such tokens are trained on. An
empty table gives no rows. Only doc_id and text are read; ``redact`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystream.llm.texts import raw_text, slices

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1_000  # documents that the field is trained on, at most
SAMPLE_TOKENS = 1_000  # tokens that such a document may have
SURE = 0.9  # posterior from which a token is labelled
ROUNDS = 100

# Documents that look like having data of a kind, to draw the training sample from.
_LOOKS = {
    "email": "@[A-Za-z0-9-]+[.]",
    "ip": "[0-9][.][0-9]+[.][0-9]+[.][0-9]",
    "card": "[0-9](?:[ -]?[0-9]){11}",
    "phone": "[+][0-9][ ().0-9-]{7}",
}

# The patterns' parts. Runs of digits are entered at their start only,
# and never given back, so that long runs take linear time and the matches stay.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, place in KINDS, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, 0, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, each kind's own leftmost ones, by start, then kind."""
    if not _CANDIDATE.search(text):
        return []
    found = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.groups()):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- The field -------------------------------------------------------------

LABELS = 1 + len(KINDS)  # 0: none
CHAIN, SAME_DIGITS, SAME_TEXT, SAME_DOMAIN = range(4)


class Graph:
    """Tokens with features, edges, and the labels that the base spans give them."""

    def __init__(self, text: str, spans: list[Span]):
        self.tokens = [m.span() for m in re.finditer(r"\S+", text) if _CANDIDATE.search(m[0])]
        n = len(self.tokens)
        words = [text[s:e] for s, e in self.tokens]
        digits = [_NOT_DIGIT.sub("", w) for w in words]
        self.labels = np.zeros(n, np.int64)
        at = 0
        for start, kind, end in spans:
            while at < n and self.tokens[at][1] <= start:
                at += 1
            k = at
            while k < n and self.tokens[k][0] < end:
                self.labels[k] = self.labels[k] or 1 + kind
                k += 1
        edges = []
        runs = np.arange(n)  # first token of the run of neighbours
        for k in range(1, n):
            if self.tokens[k][0] - self.tokens[k - 1][1] == 1:
                edges.append((k - 1, k, CHAIN))
                runs[k] = runs[k - 1]
        last: dict[tuple, int] = {}
        for k, (word, number) in enumerate(zip(words, digits)):
            keys = [(SAME_TEXT, word.strip(".,;:!?()[]<>\"'").lower())]
            if len(number) >= 7:
                keys.append((SAME_DIGITS, number))
            if "@" in word:
                keys.append((SAME_DOMAIN, word.rpartition("@")[2].strip(".,;:").lower()))
            for key in keys:
                if key[1] and key in last:
                    edges.append((last[key], k, key[0]))
                last[key] = k
        self.edges = np.array(edges, np.int64).reshape(-1, 3)
        lengths = np.array([len(d) for d in digits], np.int64)
        total = np.bincount(runs, lengths, n)[runs] if n else lengths
        self.features = np.array(
            [
                features(w, d, total[k], words[runs[k]].startswith("+"), runs[k] != k)
                for k, (w, d) in enumerate(zip(words, digits))
            ],
            np.float64,
        ).reshape(n, FEATURES)


def features(word: str, digits: str, run: int, plus: bool, inner: bool) -> list[bool]:
    n = len(digits)
    dots = word.count(".")
    return [
        True,
        "@" in word,
        "@" in word and "." in word.rpartition("@")[2],
        n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 19, n > 19,
        n + sum(map(word.count, ".,;")) == len(word),
        any(c.isalpha() for c in word),
        dots == 3 and n >= 4,
        dots > 3,
        word.startswith("+"),
        "(" in word or ")" in word,
        "-" in word,
        "=" in word or ":" in word,
        plus,
        inner,
        9 <= run <= 15,
        12 <= run <= 19,
    ]


FEATURES = len(features("", "", 0, False, False))


class Field:
    """Weights of tokens, of neighbouring labels, and of agreement along skip edges."""

    def __init__(self, graphs: list[Graph], steps: int = 300):
        self.node = np.zeros((FEATURES, LABELS))
        self.chain = np.zeros((LABELS, LABELS))
        self.skip = np.full(4, 0.5)
        self.trained = any(g.labels.any() for g in graphs)
        if not self.trained:
            return
        offsets = np.cumsum([0, *(len(g.labels) for g in graphs)])
        x = np.concatenate([g.features for g in graphs])
        y = np.concatenate([g.labels for g in graphs])
        edges = np.concatenate([g.edges + [o, o, 0] for g, o in zip(graphs, offsets)]).astype(np.int64)
        one = np.eye(LABELS)
        rate = 0.5
        for step in range(steps):
            score = x @ self.node + self._neighbours(edges, y, len(y))
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            off = one[y] - p / p.sum(axis=1, keepdims=True)
            self.node += rate * (x.T @ off / len(y) - 1e-4 * self.node)
            a, b = edges[:, 0], edges[:, 1]
            on = edges[:, 2] == CHAIN
            pair = one[y[a[on]]].T @ off[b[on]] + off[a[on]].T @ one[y[b[on]]]
            self.chain += rate * (pair / len(y) - 1e-4 * self.chain)
            for kind in (SAME_DIGITS, SAME_TEXT, SAME_DOMAIN):
                on = edges[:, 2] == kind
                gain = off[b[on], y[a[on]]].sum() + off[a[on], y[b[on]]].sum()
                self.skip[kind] = max(0.0, self.skip[kind] + rate * gain / len(y))

    def potentials(self, kinds: np.ndarray) -> np.ndarray:
        """Of each edge, by the labels of its first and second token."""
        table = np.array([self.chain, *(w * np.eye(LABELS) for w in self.skip[1:])])
        return table[kinds]

    def _neighbours(self, edges: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
        pair, out = self.potentials(edges[:, 2]), np.zeros((n, LABELS))
        rows = np.arange(len(edges))
        np.add.at(out, edges[:, 1], pair[rows, y[edges[:, 0]]])
        np.add.at(out, edges[:, 0], pair[rows, :, y[edges[:, 1]]])
        return out

    def beliefs(self, graph: Graph) -> tuple[np.ndarray, bool]:
        """Marginals by loopy sum-product, and whether the messages have converged.

        Tokens of base spans are observed. Messages go on until none moves; those that
        still do after so many rounds that news has crossed all tokens twice swing for good.
        """
        n, edges = len(graph.labels), graph.edges
        own = graph.features @ self.node
        seen = graph.labels > 0
        own[seen] = -50.0
        own[seen, graph.labels[seen]] = 50.0
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        pair = self.potentials(edges[:, 2])
        pair = np.concatenate((pair, pair.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
        message = np.zeros((len(source), LABELS))
        moved, rounds = np.inf, 0
        while moved >= 1e-4 and rounds < 2 * n + ROUNDS:
            rounds += 1
            total = own.copy()
            np.add.at(total, target, message)
            sent = (total[source] - message[back])[:, :, None] + pair
            top = sent.max(axis=1)
            new = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            new = 0.5 * (new + message)  # damped, for cycles
            moved = np.abs(new - message).max(initial=0.0)
            message = new
        total = own.copy()
        np.add.at(total, target, message)
        p = np.exp(total - total.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True), bool(moved < 1e-4)


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span], bool]:
    """Base spans, these with the field's, and whether its messages have converged."""
    base = base_spans(text)
    if not field.trained or not _CANDIDATE.search(text):
        return base, base, True
    graph = Graph(text, base)
    sure, settled = field.beliefs(graph)
    label = np.where(sure.max(axis=1) >= SURE, sure.argmax(axis=1), 0)
    label[graph.labels > 0] = 0
    added: list[Span] = []
    for (start, end), kind in zip(graph.tokens, label.tolist()):
        if not kind:
            continue
        word = text[start:end]
        start += len(word) - len(word.lstrip(".,;:!?\"'<[{"))
        end -= len(word) - len(word.rstrip(".,;:!?\"'>]}"))
        if added and added[-1][1] == kind - 1 and start - added[-1][2] == 1:
            added[-1] = (added[-1][0], kind - 1, end)
        elif start < end:
            added.append((start, kind - 1, end))
    taken = base + added
    return base, sorted(taken), settled


def train(docs: DataFrame, limit: int = SAMPLE, most: int = SAMPLE_TOKENS) -> Field:
    """A field fitted on at most ``limit`` documents of up to ``most`` tokens, by hash of doc_id.

    An equal part of them is drawn from the documents that look like having data of each
    kind, and one from those with other digits, so that a kind that is rare in the corpus is learnt, too.
    """
    text = F.col("text")
    looks = [F.when(text.rlike(_LOOKS[kind]), kind) for kind in KINDS]
    drawn = F.array_compact(F.array(*looks))
    some = docs.filter(text.rlike("[0-9@]"))
    some = some.select(F.col("doc_id").cast("long").alias("id"), drawn.alias("kinds"))
    some = some.filter("id IS NOT NULL").select(
        "id", F.explode(F.when(F.size("kinds") > 0, F.col("kinds")).otherwise(F.array(F.lit("")))).alias("kind")
    )
    # The rank's limit is applied in the tasks first: no kind's documents meet in one task.
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("id"), "id"))
    picked = some.withColumn("place", place).filter(F.col("place") <= limit // (len(KINDS) + 1))
    picked = picked.select("id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, raw in zip(*(part.column(c).to_pylist() for c in ("doc_id", "raw"))):
                    text = raw.decode("utf-8", "replace")
                    g = Graph(text, base_spans(text))
                    if 0 < len(g.labels) <= most:
                        rows.append((doc_id, g.features.ravel(), g.labels, g.edges.ravel()))
                columns = list(zip(*rows)) or [[]] * 4
                kinds = (pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "features", "labels", "edges"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), raw_text())
    rows = rows.join(F.broadcast(picked), rows["doc_id"] == picked["id"]).drop("id")
    found = rows.mapInArrow(
        run, "doc_id long, features array<double>, labels array<long>, edges array<long>"
    )
    # Rows of one id may be many: the bound holds for what is fetched, too.
    fetched = found.orderBy("doc_id", "labels", "edges", "features").limit(limit).collect()
    graphs = []
    for r in fetched:
        g = Graph("", [])
        g.features = np.array(r.features).reshape(-1, FEATURES)
        g.labels = np.array(r.labels, np.int64)
        g.edges = np.array(r.edges, np.int64).reshape(-1, 3)
        graphs.append(g)
    return Field(graphs)


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base spans by kind and as a digest, and all spans."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "converged"]
        for batch in batches:
            for part in slices(batch):
                counts, digests, spans, settled = [], [], [], []
                for raw in part.column("raw").to_pylist():
                    base, found, converged = all_spans(raw.decode("utf-8", "replace"), field)
                    settled.append(converged)
                    counts.append([sum(s[1] == k for s in base) for k in range(len(KINDS))])
                    digests.append(hashlib.sha256(spelled(base).encode()).hexdigest())
                    spans.append(spelled(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in zip(*counts)),
                        pa.array(digests),
                        pa.array(spans),
                        pa.array(settled, pa.bool_()),
                    ],
                    names,
                )

    return docs.select(F.col("doc_id").cast("long"), raw_text()).mapInArrow(
        run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, spans string, converged boolean",
    )


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, or stretch of overlapping ones, as its first kind in brackets."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join((*out, text[at:]))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; ``n_chars``, if there, is then the new length."""
    model, names, schema = docs.sparkSession.sparkContext.broadcast(train(docs)), docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                sizes = part.column("n_chars").to_pylist() if "n_chars" in names else None
                for k, text in enumerate(texts):
                    spans = all_spans(text, field)[1] if text else []
                    if spans:
                        texts[k] = masked(text, spans)
                        if sizes:
                            sizes[k] = len(texts[k])
                new = {"text": texts, "n_chars": sizes}
                columns = [
                    pa.array(new[c], part.column(c).type) if new.get(c) is not None else part.column(c)
                    for c in names
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)
