"""Secrets in texts: candidates, and a random forest that removes false ones.

A candidate is a run without blanks, quotes or brackets whose value (what stands
after a key and ``=`` or ``:``, blanks and quotes between them or not) has ``least``
characters and a digit, twelve capitals in a row or sixteen characters of mixed case,
or whose key names a secret. Its features are its length, its characters and the transitions
between them, how much of it is made of the corpus's common words, whether it
looks like a path, and the words beside it.

The forest is fitted on labelled findings. ``known_kind`` labels those that need
no judgement: values in a provider's fixed format or assigned to a key that names
a secret on the one side, plain numbers, dates, addresses and paths on the other.
Findings labelled by hand may be given instead.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, in_arrow
from tidemark.session import written

HINT = re.compile(r"[0-9=:]|[A-Z]{12}|(?:[A-Z]+[a-z]+){3}")
MIXED = re.compile(r"(?:[A-Z]+[a-z]+){3}")
#: What a run that ends in a sign is the end of, and what may stand before its value.
SIGNED = re.compile(r"([A-Za-z_][\w.-]*)[\s\"']*[=:]+$")
BETWEEN = re.compile(r"[\s\"'`<>(){}\[\]]*")
CAPITALS = re.compile(r"[A-Z]{12}")
EDGE = re.compile(r"[\s\"'`<>(){}\[\],;|]")
EDGES = frozenset(" \t\n\r\x0b\x0c\"'`<>(){}[],;|")
WORD = re.compile(r"[a-z]{4,20}")

# Words that name a secret, and providers' formats.
SECRET_WORDS = (
    "password passwd pwd pass passphrase secret token apikey api_key api-key key auth authorization bearer "
    "credential credentials private access"
).split()
FORMATS = (
    r"AKIA[0-9A-Z]{16}", r"ASIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36,}", r"xox[abprs]-[A-Za-z0-9-]{10,}",
    r"AIza[0-9A-Za-z_-]{35}", r"sk_live_[0-9a-zA-Z]{16,}", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
)
BENIGN = (
    r"[+-]?[0-9][0-9.,:%/ +-]*", r"[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}(?:T.*)?", r"https?://.*", r"www\..*",
    r"[^@]+@[^@]+\.[a-z]+", r"[A-Za-z]+[-_]?[0-9]{1,4}", r"(?:[A-Za-z0-9_.-]*/)+[A-Za-z0-9_.-]*",
)
FORMAT, HARMLESS = (re.compile("|".join(f"(?:{p})" for p in some)) for some in (FORMATS, BENIGN))

Candidate = tuple  # (start, end, key, value, before, after)


def candidates(text: str, least: int = 8) -> list[Candidate]:
    """Candidates of a text, in order; start and end are the value's place in characters."""
    found, done = [], 0
    for m in HINT.finditer(text):
        i = m.start()
        if i < done:
            continue
        begin = i
        while begin > done and text[begin - 1] not in EDGES and not text[begin - 1].isspace():
            begin -= 1
        edge = EDGE.search(text, i)
        end = done = edge.start() if edge else len(text)
        while end > begin and text[end - 1] in ".:!?=" and not (text[end - 1] == "=" and end - begin > 16):
            end -= 1
        run = text[begin:end]
        key, value, start = "", run, begin
        sign = re.search(r"[=:](?!//)", run)
        if sign and re.fullmatch(r"[A-Za-z_][\w.-]*", run[: sign.start()]):
            key, value, start = run[: sign.start()], run[sign.end() :], begin + sign.end()
        before = text[max(0, begin - 80) : begin]
        if not key and (spaced := re.search(r"([A-Za-z_][\w.-]*)[\s\"']*[=:][\s\"']*$", before)):
            key = spaced[1]
        telling = any(c.isdigit() for c in value) or CAPITALS.search(value) or len(value) >= 16 and MIXED.search(value)
        if len(value) >= least and (telling or names_secret(key)):
            found.append((start, start + len(value), key, value, before[-40:], text[done : done + 40]))
        if text[done - 1] in "=:" and (named := SIGNED.search(text[max(0, begin - 80) : done])) and names_secret(named[1]):
            # The value stands apart; one with a hint of its own is met there.
            start = BETWEEN.match(text, done).end()
            edge = EDGE.search(text, start)
            after = edge.start() if edge else len(text)
            value = text[start:after].rstrip(".:!?=")
            if len(value) >= least and not HINT.search(text, start, after):
                found.append((start, start + len(value), named[1], value, text[max(0, start - 40) : start], text[after : after + 40]))
                done = after
    return found


def names_secret(words: str) -> bool:
    return not set(re.findall(r"[a-z]+", words.lower())).isdisjoint(SECRET_WORDS) or any(
        w in words.lower() for w in ("passw", "api_key", "api-key", "apikey")
    )


def entropy(value: str) -> float:
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) if n else 0.0


def known_kind(candidate: Candidate) -> bool | None:
    """True for a secret, False for a harmless value, None where it takes judgement."""
    _, _, key, value, before, _ = candidate
    if FORMAT.fullmatch(value):
        return True
    if names_secret(key) and len(value) >= 12 and entropy(value) >= 2.5 and any(c.isalpha() for c in value):
        return True
    if HARMLESS.fullmatch(value) and not names_secret(key):
        return False
    return None


class Language:
    """Common words of the corpus and the transitions between their letters."""

    def __init__(self, counts: dict[str, int]):
        self.words = frozenset(counts)
        table = np.ones((28, 28))
        for word, k in counts.items():
            codes = [26, *(ord(c) - 97 for c in word), 26]
            for a, b in zip(codes, codes[1:]):
                table[a, b] += k
        table[27], table[:, 27] = 1, 1e-3 * table.sum(1)
        self.log = np.log(table / table.sum(1, keepdims=True))

    def transitions(self, value: str) -> float:
        codes = [ord(c) - 97 if "a" <= c <= "z" else 27 for c in value.lower()]
        return float(np.mean(self.log[codes[:-1], codes[1:]])) if len(codes) > 1 else 0.0

    def coverage(self, value: str) -> float:
        """Share of the characters that are in common words, taken from the left, longest first."""
        low, at, covered = value.lower(), 0, 0
        while at < len(low):
            size = next((n for n in range(min(20, len(low) - at), 3, -1) if low[at : at + n] in self.words), 0)
            covered += size
            at += size or 1
        return covered / len(low) if low else 0.0


FEATURES = (
    "length digits upper lower other entropy changes digit_changes transitions coverage slashes dots address key "
    "secret_key secret_before secret_after"
).split()


def features(candidate: Candidate, language: Language) -> list[float]:
    _, _, key, value, before, after = candidate
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    digit_changes = sum((a == "d") != (b == "d") for a, b in zip(kinds, kinds[1:]))
    near_before, near_after = " ".join(before.split()[-3:]), " ".join(after.split()[:3])
    return [
        n, *(kinds.count(k) / n for k in "dulo"), entropy(value), changes / n, digit_changes / n,
        language.transitions(value), language.coverage(value), value.count("/") / n, value.count(".") / n,
        float("@" in value or "://" in value), float(bool(key)), float(names_secret(key)),
        float(names_secret(near_before)), float(names_secret(near_after)),
    ]


def grow_tree(x: np.ndarray, y: np.ndarray, seed: int, depth: int = 10, leaf: int = 2) -> list[list[float]]:
    """One tree on a bootstrap: nodes of (feature or -1, threshold, left, right, share of secrets)."""
    rng = np.random.default_rng(seed)
    nodes: list[list[float]] = []
    tries = max(1, round(math.sqrt(x.shape[1])))

    def grow(rows: np.ndarray, level: int) -> int:
        here, share = len(nodes), float(y[rows].mean())
        nodes.append([-1, 0.0, 0, 0, share])
        if level == depth or len(rows) < 2 * leaf or share in (0.0, 1.0):
            return here
        best = (1e-12, -1, 0.0)
        whole = share * (1 - share)
        for f in rng.permutation(x.shape[1])[:tries]:
            column = x[rows, f]
            for cut in np.unique(np.quantile(column, np.linspace(0.05, 0.95, 15))):
                left = column <= cut
                k = int(left.sum())
                if leaf <= k <= len(rows) - leaf:
                    a, b = y[rows][left].mean(), y[rows][~left].mean()
                    gain = whole - (k * a * (1 - a) + (len(rows) - k) * b * (1 - b)) / len(rows)
                    if gain > best[0]:
                        best = (gain, int(f), float(cut))
        if best[1] >= 0:
            left = x[rows, best[1]] <= best[2]
            nodes[here][:2] = best[1], best[2]
            nodes[here][2] = grow(rows[left], level + 1)
            nodes[here][3] = grow(rows[~left], level + 1)
        return here

    grow(rng.integers(0, len(y), len(y)), 0)
    return nodes


def forest_share(trees: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """The trees' mean share of secrets for each row."""
    total = np.zeros(len(x))
    for t in trees:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = t[at, 0] >= 0
            if not inner.any():
                break
            f = np.maximum(t[at, 0], 0).astype(np.int64)
            step = np.where(x[np.arange(len(x)), f] <= t[at, 1], t[at, 2], t[at, 3])
            at = np.where(inner, step, at).astype(np.int64)
        total += t[at, 4]
    return total / max(1, len(trees))


class Judge:
    """Whether a candidate is a secret; without labels of both kinds, what its form says."""

    def __init__(self, language: Language, trees: list[np.ndarray], cut: float = 0.5):
        self.language, self.trees, self.cut = language, trees, cut

    def shares(self, some: list[Candidate]) -> np.ndarray:
        if not some:
            return np.zeros(0)
        if not self.trees:
            return np.array([float(bool(known_kind(c))) for c in some])
        return forest_share(self.trees, np.array([features(c, self.language) for c in some]))


CANDIDATE = "struct<start:int,end:int,key:string,value:string,before:string,after:string>"


def scan(docs: DataFrame, least: int = 8) -> DataFrame:
    """A row per document with its candidates, and per word of a task's share with its count there.

    All words are given, so their sums are those of the corpus however it is partitioned.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    one = pa.struct([("start", pa.int32()), ("end", pa.int32()), *((k, pa.string()) for k in ("key", "value", "before", "after"))])
    names = ["doc_id", "found", "word", "n"]

    def run(batches: Batches) -> Batches:
        counts: Counter[str] = Counter()
        id_type = pa.int64()
        for b in batches:
            id_type = b.schema.field(0).type
            some = [t or "" for t in b.column(1).to_pylist()]
            found = [[dict(zip(("start", "end", "key", "value", "before", "after"), c, strict=True)) for c in candidates(t, least)] for t in some]
            size = len(some)
            columns = [b.column(0), pa.array(found, pa.list_(one)), pa.nulls(size, pa.string()), pa.nulls(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            for t in some:
                counts.update(WORD.findall(t.lower()))
            if len(counts) > 400_000:
                yield words(counts, id_type)
                counts.clear()
        yield words(counts, id_type)

    def words(counts: Counter, id_type: pa.DataType) -> pa.RecordBatch:
        size = len(counts)
        columns = [pa.nulls(size, id_type), pa.nulls(size, pa.list_(one)), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    ddl = f"doc_id {kind}, found array<{CANDIDATE}>, word string, n long"
    return in_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, ddl)


def fit(
    spark: SparkSession,
    scanned: DataFrame,
    findings: DataFrame | None = None,
    sample: int = 20_000,
    trees: int = 32,
    dictionary: int = 20_000,
    cut: float = 0.5,
) -> Judge:
    """The judge of a corpus, from what ``scan`` has found.

    The dictionary has the ``dictionary`` commonest words. Of the labelled
    findings, at most ``sample`` of either kind are used, those with the smallest
    hashes; each tree is grown by a task of its own. ``findings`` (key, value,
    before, after, label) replaces the findings labelled by form.
    """
    top = scanned.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word")
    language = Language({r.word: r.n for r in top.limit(dictionary).collect()})
    if findings is None:
        each = scanned.where("word is null").select(F.explode("found").alias("c")).select("c.*").drop("start", "end").distinct()
        findings = in_arrow(each, _label, "key string, value string, before string, after string, label boolean")
    known = written(findings.where("label is not null"), "findings")
    rows = []
    for label in (True, False):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("key", "value", "before", "after"), "value", "before", "after")
        rows += some.limit(sample).collect()
    y = np.array([r.label for r in rows], float)
    if not len(y) or y.min() == y.max():
        return Judge(language, [], cut)
    x = np.array([features((0, 0, r.key or "", r.value or " ", r.before or "", r.after or ""), language) for r in rows])
    sent = spark.sparkContext.broadcast((x, y))

    def run(batches: Batches) -> Batches:
        for b in batches:
            for seed in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict(
                    {"tree": pa.array([seed], pa.int64()), "nodes": pa.array([grow_tree(*sent.value, seed)], pa.list_(pa.list_(pa.float64())))}
                )

    grown = in_arrow(spark.range(trees).repartition(trees), run, "tree long, nodes array<array<double>>")
    return Judge(language, [np.array(r.nodes) for r in sorted(grown.collect(), key=lambda r: r.tree)], cut)


def _label(batches: Batches) -> Batches:
    for b in batches:
        rows = zip(*(c.to_pylist() for c in b.columns), strict=True)
        yield b.append_column("label", pa.array([known_kind((0, 0, *r)) for r in rows], pa.bool_()))


def secret_report(docs: DataFrame, least: int = 8, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_candidates, n_secrets, score and the secrets' places.

    ``spans`` has (start, end) in characters, flat and ascending; ``score`` is the
    forest's highest share for a candidate, null without one. The texts are read
    once; what follows works on the candidates. Null and empty texts have none;
    rows that share an id stand one by one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = written(scan(docs, least), "candidates")
    judge = fit(docs.sparkSession, scanned, **options)
    sent = docs.sparkSession.sparkContext.broadcast(judge)

    def run(batches: Batches) -> Batches:
        for b in batches:
            found = [[tuple(c.values()) for c in row] for row in b.column(1).to_pylist()]
            shares = sent.value.shares([c for row in found for c in row])
            at, out = 0, []
            for row in found:
                mine = shares[at : at + len(row)]
                at += len(row)
                flat = [p for c, s in zip(row, mine, strict=True) if s >= sent.value.cut for p in c[:2]]
                out.append((len(row), len(flat) // 2, float(mine.max()) if row else None, flat))
            columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_candidates", "n_secrets", "score", "spans"])

    rows = scanned.where("word is null").select("doc_id", "found")
    return in_arrow(rows, run, f"doc_id {kind}, n_candidates long, n_secrets long, score double, spans array<int>")


def without_secrets(docs: DataFrame, mark: str = "[SECRET]", least: int = 8, **options) -> DataFrame:
    """``docs`` with each secret replaced by ``mark``; ``n_chars`` follows where there is one.

    Texts without a secret, and all other columns, stay as they are: a null text is
    null and an empty one empty. Repeated rows are handled one by one; an empty table
    gives an empty one.
    """
    judge = fit(docs.sparkSession, written(scan(docs, least), "candidates"), **options)
    sent = docs.sparkSession.sparkContext.broadcast(judge)
    place = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Batches) -> Batches:
        for b in batches:
            some = b.column(place).to_pylist()
            found = [candidates(t, least) if t else [] for t in some]
            shares = sent.value.shares([c for row in found for c in row])
            at, changed = 0, {}
            for k, row in enumerate(found):
                hit = [c for c, s in zip(row, shares[at : at + len(row)], strict=True) if s >= sent.value.cut]
                at += len(row)
                for start, end, *_ in reversed(hit):
                    changed[k] = (changed.get(k) or some[k])[:start] + mark + (changed.get(k) or some[k])[end:]
            columns = list(b.columns)
            if changed:
                columns[place] = pa.array([changed.get(k, t) for k, t in enumerate(some)], b.schema.field(place).type)
                if size is not None:
                    lengths = b.column(size).to_pylist()
                    columns[size] = pa.array(
                        [len(changed[k]) if k in changed else n for k, n in enumerate(lengths)], b.schema.field(size).type
                    )
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return in_arrow(docs, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
