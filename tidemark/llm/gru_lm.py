"""A gated recurrent language model over words, trained and applied in tasks.

Ids are the commonest training tokens by rank; all others share id 0. The model
is one GRU layer whose output is factored into classes of ``CLASS`` ids: the log
probability of an id is that of its class plus that of the id within it. A token
under id 0 then has the probability of its spelling: by its training count with
the weight of tokens seen before, and by a byte-pair chain with the weight of new
ones, so that all texts together have probability one.

Training runs truncated backpropagation in each task over its share of the
documents and averages the tasks' weights, round by round. Scoring carries the
state through the whole document; a window's places share one output pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, SPACED, Batches, in_arrow, row_runs, texts, word_hashes
from tidemark.session import written

CLASS = 64
END = np.uint64(0x9E3779B97F4A7C15)  # stands for the end of a text
LN10 = np.log(10.0)
BOUND = 1 / 30  # of a window's gradient norm, for each of its ids
SPELLED = 50_000  # words whose bytes are laid out at once
SLICE = 2 << 20  # bytes of text that are cut into words at once
LANES = 16  # weights in a row, when Spark adds up those of the tasks
GROUP = 6 << 20  # tokens, kept as ids, that are scored side by side


def tokenise(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text's bounds in them, the joined bytes, and starts and ends."""
    buffer = b"\n".join(some).translate(LOWER)
    hashes, starts, ends = word_hashes(buffer, SPACED)
    places = np.cumsum([len(t) + 1 for t in some])
    return hashes, np.concatenate(([0], np.searchsorted(starts, places))), buffer, starts, ends


def spelled_codes(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the given words and the edge after it, behind the two before it; 256 is an edge.

    Also the first row of each word, and the number of rows.
    """
    data = np.frombuffer(buffer, np.uint8)
    length = ends - starts + 1
    rows = np.concatenate(([0], np.cumsum(length)))
    at = np.arange(rows[-1]) + np.repeat(starts - rows[:-1], length)
    out = np.empty((len(at), 3), np.int32)  # bytes alone have no place for the edge
    out[:, 2] = data[np.minimum(at, len(data) - 1)]
    out[rows[1:] - 1, 2] = 256
    for k in (1, 0):
        out[1:, k] = out[:-1, k + 1]
        out[rows[:-1], k] = 256
    return out, rows


def codes_of(seen: np.ndarray, codes: int) -> np.ndarray:
    """The code of each byte: 1 and on for the commonest, 0 for the edge, the last for all others."""
    top = np.argsort(-seen[:256], kind="stable")[: codes - 2]
    code = np.full(257, codes - 1)
    code[top] = np.arange(1, len(top) + 1)
    code[256] = 0
    return code


class Chain:
    """Spelling probabilities: byte triples over the commonest bytes, mixed with byte pairs.

    Bytes beyond the ``codes`` - 2 commonest share a code and one even chance each.
    """

    def __init__(self, triples: np.ndarray, counts: np.ndarray, codes: int = 96, seen: np.ndarray | None = None):
        """From triples of bytes (or sums of triples with equal codes) and their counts.

        ``seen`` has the count of every byte, if ``triples`` are such sums.
        """
        self.code = codes_of(np.bincount(triples % 257, counts, minlength=257) if seen is None else seen, codes)
        a, b, c = (self.code[x] for x in (triples // 66_049, triples // 257 % 257, triples % 257))
        table = np.bincount((a * codes + b) * codes + c, counts, minlength=codes**3).reshape(codes, codes, codes)
        pairs = table.sum(0) + 0.05
        pairs /= pairs.sum(1, keepdims=True)
        known = table.sum(2, keepdims=True)
        mixed = (table + 4 * pairs[None]) / (known + 4)
        self.log = np.log10(mixed).astype(np.float32)
        self.other = np.log10(257 - codes + 1)
        self.small = self.code[:256].astype(np.uint8)
        self.each = self.log.copy()
        self.each[:, :, codes - 1] -= self.other
        self.each = self.each.ravel()

    def spell(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of each word's spelling, its end included."""
        if len(starts) > SPELLED:
            parts = range(0, len(starts), SPELLED)
            return np.concatenate([self.spell(buffer, starts[i : i + SPELLED], ends[i : i + SPELLED]) for i in parts])
        if not len(starts):
            return np.zeros(0)
        length = ends - starts + 1
        begins = np.cumsum(length) - length
        at = np.arange(begins[-1] + length[-1]) + np.repeat(starts - begins, length)
        # The edge after a word has code 0, and so have the two places before it.
        last = self.small[np.frombuffer(buffer, np.uint8)[np.minimum(at, len(buffer) - 1)]].astype(np.int32)
        last[begins + length - 1] = 0
        one, two = np.zeros_like(last), np.zeros_like(last)
        one[1:] = last[:-1]
        two[1:] = one[:-1]
        two[begins] = 0
        codes = len(self.log)
        return np.add.reduceat(self.each.take((two * codes + one) * codes + last), begins, dtype=np.float64)


@dataclass
class Words:
    """What the corpus's counts give: commonest tokens, totals and the spelling chain."""

    common: np.ndarray  # hashes of the commonest tokens, sorted
    counts: np.ndarray  # their training counts
    ids: np.ndarray  # their ids; 0 past the model's vocabulary
    vocabulary: np.ndarray  # training count per id
    total: int
    distinct: int
    new_share: float  # of the tokens under id 0
    chain: Chain

    @property
    def rest(self) -> int:
        return int(self.vocabulary[0])

    @cached_property
    def shift(self) -> np.uint64:
        """What leaves a hash's leading bits, about eight times as many values as there are common tokens."""
        return np.uint64(64 - (8 * len(self.common)).bit_length())

    @cached_property
    def first(self) -> np.ndarray:
        """The first common token of each value of the leading bits."""
        seen = np.bincount((self.common >> self.shift).astype(np.int64), minlength=1 << (64 - int(self.shift)))
        return np.concatenate(([0], np.cumsum(seen))).astype(np.int32)


def distinct(hashes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct hash, and the sum of ``n`` over all its places."""
    order = np.argsort(hashes)
    found = hashes[order]
    firsts = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))[: len(found)])
    return order[firsts], np.add.reduceat(n[order], firsts) if len(firsts) else n[:0]


def count_tokens(rows: DataFrame) -> DataFrame:
    """(kind, token, n): training counts by hash (kind 0) and byte triples of distinct words (kind 1)."""

    def run(batches: Batches) -> Batches:
        for some in slices(batches, lambda b: [t for t, h in zip(texts(b), b.column(1).to_pylist(), strict=True) if not h]):
            parts, before = [], 0
            for begin, end in row_runs(np.array([len(t) for t in some]), SLICE):
                hashes, _, buffer, starts, ends = tokenise(some[begin:end])
                at, n = distinct(hashes, np.ones(len(hashes), np.int64))
                parts.append((hashes[at], n, starts[at] + before, ends[at] + before, buffer))
                before += len(buffer)
            *arrays, buffers = zip(*parts, strict=True)
            hashes, n, starts, ends = map(np.concatenate, arrays)
            buffer = b"".join(buffers)
            first, n = distinct(hashes, n)
            yield batch(0, hashes[first].view(np.int64), n)
            yield batch(0, np.array([END]).view(np.int64), np.array([len(some)]))
            # Each distinct word once: new words are spelled like rare ones.
            for i in range(0, len(first), SPELLED):
                codes, _ = spelled_codes(buffer, starts[first[i : i + SPELLED]], ends[first[i : i + SPELLED]])
                triples, m = np.unique((codes[:, 0] * 257 + codes[:, 1]) * 257 + codes[:, 2], return_counts=True)
                yield batch(1, triples.astype(np.int64), m)

    def batch(kind: int, token, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(token), kind, np.int32)), pa.array(token), pa.array(n.astype(np.int64))], names=["kind", "token", "n"]
        )

    counted = in_arrow(rows, run, "kind int, token long, n long")
    return written(counted.groupBy("kind", "token").agg(F.sum("n").alias("n")), "token-counts")


def slices(batches: Batches, take, size: int = 16 << 20):
    """Lists of about so many bytes of text, over the batches of a task.

    Of a batch, no more than that is out of its columns at a time.
    """
    held, total = [], 0
    for b in batches:
        lengths = np.asarray(pc.binary_length(b.column(b.schema.get_field_index("text"))).fill_null(0))
        for begin, end in row_runs(lengths, size):
            for t in take(b.slice(begin, end - begin)):
                held.append(t)
                total += len(t)
                if total >= size:
                    yield held
                    held, total = [], 0
    if held:
        yield held


def learn_words(counts: DataFrame, vocabulary: int, common: int) -> Words:
    """The tables that are sent to all tasks: at most ``common`` tokens, and the spelling chain of a fixed size."""
    tokens = counts.where("kind = 0")
    sums = tokens.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.count_if(F.col("n") == 1).alias("once")).first()
    # The end token comes first, however rare it is.
    end = F.col("token") == F.lit(int(END.astype(np.int64)))
    top = tokens.orderBy(end.desc(), F.desc("n"), "token").limit(common).collect()
    hashes = np.array([r.token for r in top], np.int64).view(np.uint64)
    n = np.array([r.n for r in top], np.int64)
    ids = np.where(np.arange(len(top)) < vocabulary - 1, np.arange(1, len(top) + 1), 0)
    total, distinct = int(sums.total or 0), int(sums.distinct)
    known = n[: vocabulary - 1]
    rest = total - int(known.sum())
    once = min(int(sums.once), rest)
    chain = learn_chain(counts.where("kind = 1"))
    by = np.argsort(hashes)
    return Words(
        hashes[by], n[by], ids[by], np.concatenate(([rest], known)), total, distinct,
        min(max((once + 1) / (rest + 2), 1e-6), 1.0) if rest else 1.0,
        chain,
    )


def learn_chain(triples: DataFrame, codes: int = 96) -> Chain:
    """The chain of all counted byte triples (token, n).

    Spark adds up triples with the same codes first, so at most codes**3 sums come to
    the driver, whatever the corpus.
    """
    seen = np.zeros(257)
    for r in triples.groupBy((F.col("token") % 257).alias("byte")).agg(F.sum("n").alias("n")).collect():
        seen[r["byte"]] = r["n"]
    seen[256] = 0
    code = codes_of(seen, codes)
    # The first byte with a code stands for all that share it.
    stand = np.array([int(np.flatnonzero(code == c)[0]) for c in code])
    like = F.array(*[F.lit(int(b)) for b in stand])
    a, b, c = (F.get(like, x.cast("int")) for x in (F.floor(F.col("token") / 66_049), F.floor(F.col("token") / 257) % 257, F.col("token") % 257))
    sums = triples.groupBy(((a * 257 + b) * 257 + c).cast("long").alias("token")).agg(F.sum("n").alias("n")).toArrow()
    return Chain(sums.column("token").to_numpy(), sums.column("n").to_numpy(), codes, seen)


# The network: a dict of arrays, so that averages and updates are loops over it.

Net = dict[str, np.ndarray]


def new_net(vocabulary: np.ndarray, hidden: int, seed: int = 1) -> Net:
    """Small random weights; output biases are the log counts, so it starts as a unigram model."""
    rng = np.random.default_rng(seed)
    classes = -(-len(vocabulary) // CLASS)
    counts = np.zeros(classes * CLASS)
    counts[: len(vocabulary)] = vocabulary + 0.5
    table = counts.reshape(classes, CLASS)

    def small(*shape: int) -> np.ndarray:
        return rng.normal(0, 0.08, shape).astype(np.float32)

    return {
        "embed": small(len(vocabulary), hidden),
        "wx": small(hidden, 3 * hidden), "wh": small(hidden, 3 * hidden), "b": np.zeros(3 * hidden, np.float32),
        "cw": small(hidden, classes) * 0.1, "cb": np.log(table.sum(1)).astype(np.float32),
        "ow": small(classes, hidden, CLASS) * 0.1,
        "ob": np.log(np.maximum(table, 1e-30)).astype(np.float32),
    }


def by_value(x: np.ndarray) -> np.ndarray:
    """The order of ids; numpy sorts those of 16 bits in passes over the digits."""
    return np.argsort(x.astype(np.min_scalar_type(int(x.max(initial=0)))), kind="stable")


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of ``x``."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    """By one exponential, which numpy has faster than the function itself; in place of ``x``."""
    x += x
    sigmoid(x)
    x += x
    x -= 1
    return x


def softmax(x: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln probability of each row's chosen place, and the inverse of the rows' sums; ``x`` becomes its exponentials."""
    if x.max() > 60 or x.min() < -60:
        x -= x.max(1, keepdims=True)
    picked = x[np.arange(len(x)), chosen]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return picked - np.log(total), 1 / total


def output(net: Net, h: np.ndarray, target: np.ndarray, backward: bool = False, part: int = 4096):
    """ln probabilities of the targets; with ``backward`` also the gradients of their negative sum.

    Places are put in the order of their classes once, so each class is a slice, and
    worked on a ``part`` at a time, so that a part's tables stay in the cache.
    """
    order = by_value(target)
    kind, inner = np.divmod(target[order], CLASS)
    n, out, back = h.shape[1], np.empty(len(h), h.dtype), np.empty_like(h)
    # Biases are a last row of the weights, which meets a one behind each state.
    cw = np.concatenate((net["cw"], net["cb"][None]))
    ow = np.concatenate((net["ow"], net["ob"][:, None]), 1)
    dcw, dow, cw_t = np.zeros_like(cw), np.zeros_like(ow), net["cw"].T.copy()
    for begin in range(0, len(h), part):
        at = order[begin : begin + part]
        k, i, rows = kind[begin : begin + part], inner[begin : begin + part], np.arange(len(at))
        hs = np.ones((len(at), n + 1), h.dtype)
        hs[:, :n] = h.take(at, 0)
        dc = hs @ cw
        logp, over = softmax(dc, k)
        edges = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True])))
        do = np.empty((len(at), CLASS), h.dtype)
        slices = [(int(k[a]), slice(a, b)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        for c, some in slices:
            np.matmul(hs[some], ow[c], out=do[some])
        within, inner_over = softmax(do, i)
        out[at] = logp + within
        if not backward:
            continue
        dc *= over[:, None]
        do *= inner_over[:, None]
        dc[rows, k] -= 1
        do[rows, i] -= 1
        dcw += hs.T @ dc
        dh = dc @ cw_t
        for c, some in slices:
            dow[c] += hs[some].T @ do[some]
            dh[some] += do[some] @ net["ow"][c].T
        back[at] = dh
    return (out, {"cw": dcw[:n], "cb": dcw[n], "ow": dow[:, :n], "ob": dow[:, n]}, back) if backward else out


def cell(table_row: np.ndarray, h: np.ndarray, wh: np.ndarray):
    """One step for a batch: the new state and what backpropagation needs."""
    n = h.shape[1]
    gates = h @ wh[:, : 2 * n]
    gates += table_row[:, : 2 * n]
    sigmoid(gates)
    hn = h @ wh[:, 2 * n :]
    new = hn * gates[:, n:]
    new += table_row[:, 2 * n :]
    tanh(new)
    out = h - new
    out *= gates[:, :n]
    out += new
    return out, (gates, new, hn)


def run_sums(rows: np.ndarray, firsts: np.ndarray, long: int = 16) -> np.ndarray:
    """The sum of each run of rows: long runs alone, of all others the second rows, the third, and so on."""
    sizes = np.diff(firsts, append=len(rows))
    out = rows.take(firsts, 0)
    for k in np.flatnonzero(sizes >= long).tolist():
        rows[firsts[k] : firsts[k] + sizes[k]].sum(0, out=out[k])
    j, some = 1, np.flatnonzero(sizes < long)
    while len(some := some[sizes[some] > j]):
        out[some] += rows.take(firsts[some] + j, 0)
        j += 1
    return out


def train_window(net: Net, x: np.ndarray, y: np.ndarray, h: np.ndarray, end: int):
    """Loss gradients of one window of streams (streams, steps) and the state after it.

    The ids' input rows are worked out once for the window, and the rows' gradients
    are added up by id before they go back through the input weights.
    """
    steps, b, n = x.shape[1], len(x), h.shape[1]
    flat = x.T.ravel()
    order = by_value(flat)
    first = np.concatenate(([True], flat[order[1:]] != flat[order[:-1]]))
    firsts = np.flatnonzero(first)
    ids = flat[order[firsts]]
    place = np.empty(len(flat), np.int64)
    place[order] = np.cumsum(first) - 1
    place = place.reshape(steps, b)
    table = net["embed"][ids] @ net["wx"] + net["b"]
    live = (x != end).astype(h.dtype).T[:, :, None]
    kept, inputs, states = [], np.empty((steps, b, n), h.dtype), np.empty((steps, b, n), h.dtype)
    for t in range(steps):
        # A text starts from an empty state.
        np.multiply(h, live[t], out=inputs[t])
        states[t], more = cell(table.take(place[t], 0), inputs[t], net["wh"])
        kept.append(more)
        h = states[t]
    h = h.copy()
    logp, grads, dflat = output(net, states.reshape(-1, n), y.T.ravel(), backward=True)
    dh, wh_t = np.zeros_like(h), net["wh"].T.copy()
    # Gradients before the gates, before the new states, and of the old states' part in those.
    dgates, dnews, dhns = (np.empty((steps, b, k), h.dtype) for k in (2 * n, n, n))
    for t in reversed(range(steps)):
        dh += dflat[t * b : (t + 1) * b]
        gates, new, hn = kept[t]
        dgate, dnew = dgates[t], dnews[t]
        slope = 1 - gates
        np.multiply(new, new, out=dnew)
        np.subtract(1, dnew, out=dnew)
        dnew *= slope[:, :n]
        dnew *= dh
        slope *= gates
        np.subtract(inputs[t], new, out=dgate[:, :n])
        dgate[:, :n] *= dh
        np.multiply(dnew, hn, out=dgate[:, n:])
        dgate *= slope
        np.multiply(dnew, gates[:, n:], out=dhns[t])
        dh *= gates[:, :n]
        dh += dgate @ wh_t[: 2 * n]
        dh += dhns[t] @ wh_t[2 * n :]
        dh *= live[t]
    inputs, dgates, dnews, dhns = (v.reshape(-1, v.shape[2]) for v in (inputs, dgates, dnews, dhns))
    grads["wh"] = np.concatenate((inputs.T @ dgates, inputs.T @ dhns), 1)
    dtable = run_sums(np.concatenate((dgates, dnews), 1).take(order, 0), firsts)
    grads["b"] = dtable.sum(0)
    grads["wx"] = net["embed"][ids].T @ dtable
    grads["embed"] = np.zeros_like(net["embed"])
    grads["embed"][ids] = dtable @ net["wx"].T
    return {k: grads[k] for k in net}, h, float(logp.sum())


def train(
    net: Net, ids: np.ndarray, end: int, streams: int = 1024, steps: int = 16, rate: float = 0.2, squares: Net | None = None
) -> Net:
    """One pass of truncated backpropagation over a run of texts, each closed by ``end``.

    Gradients are summed over a window's ids and bounded in proportion to their
    number. ``squares`` carries AdaGrad's sums from run to run; it is changed.
    """
    net = {k: v.copy() for k, v in net.items()}
    squares = {} if squares is None else squares
    for k, v in net.items():
        squares.setdefault(k, np.full_like(v, 1.0))
    streams = max(1, min(streams, len(ids) // (2 * steps)))
    # The first ``more`` streams are longer by one id, so that every id is in one.
    length, more = divmod(len(ids), streams)
    longer, plain = np.split(ids, [more * (length + 1)])
    y = np.full((streams, length + 1), end)
    y[:more], y[more:, :length] = longer.reshape(more, length + 1), plain.reshape(-1, length)
    x = np.concatenate((np.full((streams, 1), end), y[:, :-1]), 1)
    h = np.zeros((streams, net["wh"].shape[0]), np.float32)
    windows = [(streams, t, min(t + steps, length)) for t in range(0, length, steps)]
    for live, t, to in [*windows, (more, length, length + 1)] if more else windows:
        grads, h, _ = train_window(net, x[:live, t:to], y[:live, t:to], h[:live], end)
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        bound = max(50.0, live * (to - t) * BOUND)
        scale = net["b"].dtype.type(min(1.0, bound / (norm + 1e-9)))
        for k, g in grads.items():
            g *= scale
            squares[k] += g * g
            net[k] -= rate * g / np.sqrt(squares[k])
    return net


def look_up(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Model ids and training counts of tokens; both 0 where a token isn't a common one."""
    if not len(words.common):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
    top = (hashes >> words.shift).view(np.int64)
    at = np.minimum(words.first.take(top), len(words.common) - 1)
    known = words.common.take(at) == hashes
    # The few that share their leading bits with another common token go on to the next one.
    left = np.flatnonzero(~known)
    last = words.first.take(top[left] + 1) - 1
    while len(left := left[(more := at[left] < last)]):
        last = last[more]
        at[left] += 1
        known[left] = hit = words.common[at[left]] == hashes[left]
        left, last = left[~hit], last[~hit]
    return np.where(known, words.ids[at], 0), np.where(known, words.counts[at], 0)


def end_id(words: Words) -> int:
    return int(look_up(words, np.array([END]))[0][0])


def score_texts(net: Net, words: Words, ids: np.ndarray, bounds: np.ndarray, window: int = 1 << 14) -> np.ndarray:
    """log10 probability of each text's ids and its end, the state carried through the text."""
    end = end_id(words)
    ids, lengths = np.insert(ids, bounds[1:], end), np.diff(bounds) + 1
    order = np.argsort(-lengths, kind="stable")
    begins = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max(initial=0))
    # Texts are in falling length: those with a token at t come first.
    lives = len(order) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
    table = net["embed"] @ net["wx"] + net["b"]
    h = np.zeros((len(order), net["wh"].shape[0]), np.float32)
    total, rows = np.zeros(len(order)), np.arange(len(order))
    last = np.full(len(order), end)
    states, targets, who, held = [], [], [], 0
    for t, live in enumerate(lives.tolist()):
        h, _ = cell(table.take(last[:live], 0), h[:live], net["wh"])
        last = ids[begins[:live] + t]
        states.append(h)
        targets.append(last)
        who.append(rows[:live])
        held += live
        # A window ends when it holds enough places for the output to be worked out at once.
        if held >= window or t == longest - 1:
            logp = output(net, np.concatenate(states), np.concatenate(targets))
            total += np.bincount(np.concatenate(who), logp, minlength=len(order))
            states, targets, who, held = [], [], [], 0
    out = np.empty(len(order))
    out[order] = total / LN10
    return out


# Spark: counts, training rounds, scores.


def _blocks(net: Net) -> np.ndarray:
    return np.concatenate([v.ravel() for v in net.values()])


def _net_of(vector: np.ndarray, like: Net) -> Net:
    cuts = np.cumsum([v.size for v in like.values()])[:-1]
    return {k: p.reshape(v.shape).astype(np.float32) for (k, v), p in zip(like.items(), np.split(vector, cuts), strict=True)}


def train_round(rows: DataFrame, net: Net, words: Words) -> Net:
    """Every task trains on its documents from ``net``; the weights are averaged by tokens."""
    sent = rows.sparkSession.sparkContext.broadcast((net, words))

    def run(batches: Batches) -> Batches:
        mine, known = sent.value
        end, tokens, squares = end_id(known), 0, {}
        for some in slices(batches, texts, 4 << 20):
            hashes, bounds, *_ = tokenise(some)
            ids = look_up(known, hashes)[0]
            ids = np.insert(ids, bounds[1:], end)
            mine = train(mine, ids, end, squares=squares)
            tokens += len(ids)
        if tokens:
            part = np.append(_blocks(mine).astype(np.float64) * tokens, tokens)
            table = np.resize(part, (-(-len(part) // LANES), LANES)).T
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (np.arange(table.shape[1]), *table)], names=["at", *lanes])

    size = sum(v.size for v in net.values())
    lanes = [f"v{i}" for i in range(LANES)]
    parts = in_arrow(rows, run, "at long, " + ", ".join(f"{v} double" for v in lanes))
    sums = parts.groupBy("at").agg(*(F.sum(v).alias(v) for v in lanes)).toArrow()
    total = np.empty((len(sums), LANES))
    total[sums.column("at").to_numpy()] = np.stack([sums.column(v).to_numpy() for v in lanes], 1)
    total = total.ravel()[: size + 1]
    return _net_of(total[:-1] / total[-1], net) if len(total) else net


def language_scores(
    docs: DataFrame,
    vocabulary: int = 4096,
    common: int = 131_072,
    hidden: int = 24,
    one_in: int = 3,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, an add-one base score and the model's score.

    Words are cut at space and 0x09-0x0D, A-Z lower-cased; each text ends with one
    more token. Documents whose crc32(doc_id as text) mod 7 is 2 are held out;
    all others are counted in full (a null id counts as the text ""). Each round
    trains on one in ``one_in`` of them, by the hash of the id, and there are
    ``one_in`` rounds: together they train on every one of them once.

    Only ``common`` tokens, the net and the byte chain are sent to tasks. All other
    tokens of a text meet their counts in a join on the token. Null texts are
    empty: their one token is the end. Repeated rows stand one by one.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    crc = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))
    rows = docs.select("doc_id", (crc % 7 == 2).alias("held_out"), F.col("text").cast("string").alias("text"), crc.alias("crc"))
    counts = count_tokens(rows.select("doc_id", "held_out", "text"))
    words = learn_words(counts, vocabulary, common)
    net = new_net(words.vocabulary, hidden)
    for r in range(one_in):
        # Integer division by 7 keeps the share independent of the held-out rest.
        share = rows.where(~F.col("held_out") & (F.floor(F.col("crc") / 7) % one_in == r))
        net = train_round(share.select("doc_id", "held_out", "text"), net, words)
    sent = docs.sparkSession.sparkContext.broadcast((net, words))

    def run(batches: Batches) -> Batches:
        known_net, known = sent.value
        end_seen = int(look_up(known, np.array([END]))[1][0])
        task, row, held, tokens = TaskContext.get().partitionId(), 0, [], 0

        def scored() -> Batches:
            """The rows held, with the net's part of their scores: the more texts side by side, the fewer its steps."""
            ids = np.concatenate([i for i, *_ in held])
            bounds = np.concatenate(([0], np.cumsum(np.concatenate([np.diff(b) for _, b, *_ in held]))))
            score, begin = score_texts(known_net, known, ids, bounds), 0
            for _, b, columns in held:
                some = slice(begin, begin + len(b) - 1)
                begin = some.stop
                yield pa.RecordBatch.from_pydict(columns | {"score": columns["score"] + score[some]})

        for some in slices(batches, _Rows, SLICE):
            hashes, bounds, buffer, starts, ends = tokenise([s.text for s in some])
            ids, seen = look_up(known, hashes)
            owner = np.repeat(np.arange(len(some)), np.diff(bounds))
            common_token = seen > 0
            base = np.bincount(owner, np.log10(seen + 1.0), minlength=len(some)) + np.log10(end_seen + 1.0)
            n_known = np.bincount(owner[common_token], minlength=len(some)) + (end_seen > 0)
            # Spelling of the tokens under id 0: common ones here, the others after the join.
            plain = np.flatnonzero(ids == 0)
            spelled = known.chain.spell(buffer, starts[plain], ends[plain])
            inside = common_token[plain]
            score = np.bincount(owner[plain[inside]], _spelling(known, seen[plain[inside]], spelled[inside]), minlength=len(some))
            rare, spelled = plain[~inside], spelled[~inside]
            cuts = pa.array(np.searchsorted(owner[rare], np.arange(len(some) + 1)), pa.int32())
            columns = {
                "row": task << 40 | np.arange(row, row + len(some)),
                "doc_id": pa.array([s.doc_id for s in some], some[0].kind),
                "held_out": pa.array([s.held_out for s in some], pa.bool_()),
                "n_tokens": np.diff(bounds) + 1,
                "n_known": n_known.astype(np.int64),
                "base": base,
                "score": score,
                "rare": pa.ListArray.from_arrays(cuts, pa.array(hashes[rare].view(np.int64))),
                "spelled": pa.ListArray.from_arrays(cuts, pa.array(spelled.astype(np.float32))),
            }
            held.append((ids.astype(np.int32), bounds, columns))
            row, tokens = row + len(some), tokens + len(ids) + len(some)
            if tokens >= GROUP:
                yield from scored()
                held, tokens = [], 0
        if held:
            yield from scored()

    ddl = (
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "rare array<long>, spelled array<float>"
    )
    scored = written(in_arrow(rows.select("doc_id", "held_out", "text"), run, ddl), "scores")
    each = scored.select("row", F.explode(F.arrays_zip("rare", "spelled")).alias("t")).select(
        "row", F.col("t.rare").alias("token"), F.col("t.spelled").alias("spelled")
    )
    c = F.coalesce(F.col("n"), F.lit(0))
    spelling = F.log10(
        F.lit(1 - words.new_share) * c / max(1, words.rest) + F.lit(words.new_share) * F.pow(F.lit(10.0), F.col("spelled").cast("double"))
    )
    # A text's product of many tiny numbers stays above zero as its logarithm.
    spelling = F.when(c > 0, spelling).otherwise(F.lit(float(np.log10(words.new_share))) + F.col("spelled").cast("double"))
    more = (
        each.join(counts.where("kind = 0").select("token", "n"), "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(c + 1.0)).alias("more_base"),
            F.count_if(c > 0).alias("more_known"),
            F.sum(spelling).alias("more_score"),
        )
    )
    norm = float(np.log10(words.total + words.distinct + 1))
    return scored.drop("rare", "spelled").join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


@dataclass
class _Row:
    doc_id: object
    held_out: bool
    text: bytes
    kind: pa.DataType

    def __len__(self) -> int:
        return len(self.text)


class _Rows(list):
    def __init__(self, batch: pa.RecordBatch):
        kind = batch.schema.field(0).type
        super().__init__(
            _Row(d, h, t, kind)
            for d, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True)
        )


def _spelling(words: Words, seen: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """log10 probability of a token that the model knows as id 0, given that it is one."""
    return np.log10((1 - words.new_share) * seen / max(1, words.rest) + words.new_share * 10.0**spelled)

