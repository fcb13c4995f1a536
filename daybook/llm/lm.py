"""Scoring by a gated recurrent language model.

Word statistics cover every training token. The network, a GRU with a
class-factored softmax over the most frequent words, is trained by truncated
backpropagation in replicas: every task trains one on its own documents, and
the replicas' weights are averaged, round after round. A word outside the
network's vocabulary is one RARE token to it and then drawn from the counts
of rare words, so every text has a proper probability. The state is carried
across windows from a document's first token to its end token.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import byte_batches, cut, fields

END = ""  # no word is empty, so the empty string can stand for a document's end
WORDS = 8192  # vocabulary of the network, the end token and RARE included
CLASSES = 96
EMBED = 12
HIDDEN = 16
LANES = 512  # documents trained side by side
WINDOW = 32  # steps that training goes back, at least
SCORE_LANES = 512
SCORE_WINDOW = 64
CELLS = 1 << 21  # ids laid out side by side at once
BLOCK = 512  # states whose classes are weighed at once, so that they stay in the cache
SAFE = 60.0  # logits that exp takes in single precision without a shift
TEXTS = 8 << 20  # characters of text scored at once
PART = 8192  # weights of all replicas that one task averages
ROUNDS = 2
RATE = 0.02
CLIP = 5.0
KNOWN = 200_000  # most frequent words that travel with the tasks; the rest is joined
FLUSH = 400_000  # distinct words counted before a task passes them on


def words_of(texts: Sequence[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of whole texts, one text after the other and END after each, and where each text's begin.

    A-Z are lower-cased; texts are split on ASCII white space only. A blank that
    closes a text makes the split end in an empty string, which is END.
    """
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(pa.array(texts, pa.string()), "")))
    closing = pc.if_else(pc.equal(plain, ""), "", " ")
    lists = pc.ascii_split_whitespace(pc.binary_join_element_wise(plain, closing, ""))
    return lists.flatten(), lists.offsets.to_numpy().astype(np.int64)


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: list[pa.Table] = []
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in byte_batches(texts):
            found = pc.value_counts(words_of(texts[a:b])[0])
            seen.append(pa.table({"word": found.field(0), "n": found.field(1)}))
            if sum(map(len, seen)) > 4 * FLUSH:  # parts repeat each other's words
                seen = [_summed(seen)]
                if len(seen[0]) > FLUSH:
                    yield seen.pop().to_pandas()
    if seen:
        yield _summed(seen).to_pandas()


def count_words(texts: DataFrame) -> DataFrame:
    """word, n over all rows of ``texts`` (column text); the empty word counts the documents' ends."""
    parts = texts.select("text").mapInPandas(_count, fields(word="string", n="long"))
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


@dataclass
class Vocabulary:
    """Words of the network in order of their classes; id 0 is RARE, alone in class 0."""

    ids: dict[bytes, int]
    starts: np.ndarray  # first id of each class, and the end of the last
    prior: np.ndarray  # counts by id

    @property
    def size(self) -> int:
        return int(self.starts[-1])

    def class_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def vocabulary(top: list[tuple[bytes, int]], rare: int, classes: int = CLASSES) -> Vocabulary:
    """Classes of about equal summed root counts, most frequent words first."""
    weight = np.sqrt(np.array([n for _, n in top], dtype=np.float64))
    share = np.cumsum(weight) / weight.sum() if len(top) else weight
    of = np.minimum(1 + (share * (classes - 1) - 1e-9).astype(np.int64), classes - 1)
    used = np.unique(of)
    counts = np.array([int((of == c).sum()) for c in used], dtype=np.int64)
    starts = np.concatenate([[0, 1], 1 + np.cumsum(counts)]) if len(top) else np.array([0, 1])
    return Vocabulary({w: i + 1 for i, (w, _) in enumerate(top)}, starts, np.array([max(rare, 1), *(n for _, n in top)], dtype=np.float64))


class Network:
    """The GRU and its weights, all views of one flat vector so that replicas can be averaged."""

    def __init__(self, v: Vocabulary, flat: np.ndarray | None = None, embed: int = EMBED, hidden: int = HIDDEN, seed: int = 5):
        self.v, self.hidden = v, hidden
        classes = len(v.starts) - 1
        self.shapes = {"x": (v.size, embed), "wx": (embed, 3 * hidden), "wh": (hidden, 3 * hidden), "b": (3 * hidden,),
                       "cw": (hidden, classes), "cb": (classes,), "ow": (v.size, hidden), "ob": (v.size,)}
        n = sum(int(np.prod(s)) for s in self.shapes.values())
        fresh = flat is None
        self.flat = np.zeros(n, dtype=np.float32) if fresh else np.asarray(flat, dtype=np.float32).copy()
        self.w = self.views(self.flat)
        self.classes = v.class_of()
        if fresh:
            rng = np.random.default_rng(seed)
            for k, scale in (("x", 0.3), ("wx", embed ** -0.5), ("wh", hidden ** -0.5)):
                self.w[k][:] = rng.normal(0, scale, self.shapes[k])
            # With output weights of zero the network starts as the unigram model.
            group = np.add.reduceat(v.prior, v.starts[:-1])
            self.w["cb"][:] = np.log(group / group.sum())
            self.w["ob"][:] = np.log(v.prior / group[self.classes])

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[k] = flat[at:at + n].reshape(shape)
            at += n
        return out

    def unit(self) -> np.ndarray:
        """One step's weights as one matrix. It takes columns of an input, a 1 and a state; its rows
        give both gates, the candidate's part from the input and that from the state."""
        w, d, e = self.w, self.hidden, self.w["wx"].shape[0]
        a = np.zeros((4 * d, e + 1 + d), self.flat.dtype)
        a[:3 * d, :e], a[:3 * d, e] = w["wx"].T, w["b"]
        a[:2 * d, e + 1:], a[3 * d:, e + 1:] = w["wh"][:, :2 * d].T, w["wh"][:, 2 * d:].T
        return a

    def halved(self) -> np.ndarray:
        """``unit`` as ``advance`` takes it: the gates' rows halved, as a sigmoid is (1 + tanh(x / 2)) / 2."""
        a = self.unit()
        a[:2 * self.hidden] *= 0.5
        return a

    def advance(self, raw: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The states, in columns, after ``h``. ``raw`` is ``halved`` times the step's columns; what going
        back needs takes its place: the gates, the candidate and its recurrent part."""
        d = self.hidden
        gates, cand = raw[:2 * d], raw[2 * d:3 * d]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        cand += gates[d:] * raw[3 * d:]
        np.tanh(cand, out=cand)
        out = cand - h
        out *= gates[:d]
        out += h
        return out

    def step(self, inputs: np.ndarray, h: np.ndarray) -> tuple:
        """One step over rows; ``inputs`` are rows of x @ wx + b. Returns the new states and what ``advance`` keeps."""
        d = self.hidden
        rec = (h @ self.w["wh"]).T
        raw = np.concatenate([(inputs.T[:2 * d] + rec[:2 * d]) / 2, inputs.T[2 * d:], rec[2 * d:]])
        return self.advance(raw, h.T).T, raw

    def outputs(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Weights of classes and of words in columns with their biases as last row, and whether logits may
        be large: states lie between -1 and 1, so the sum of a column's absolute weights bounds its logit."""
        cw = np.concatenate([self.w["cw"], self.w["cb"][None]])
        ow = np.concatenate([self.w["ow"].T, self.w["ob"][None]])
        return cw, ow, max(float(np.abs(cw).sum(axis=0).max()), float(np.abs(ow).sum(axis=0).max())) > SAFE

    def _by_word(self, target: np.ndarray, some: np.ndarray | None = None):
        """Positions (``some``, or all) in order of their target's id, so of its class too; those targets, their
        classes, and (first id, end, from, to) of every class of several words that occurs."""
        ids = target if some is None else target[some]
        order = np.argsort(ids.astype(np.uint16) if self.v.size <= 1 << 16 else ids, kind="stable")
        ids = ids[order]
        edges = np.searchsorted(ids, self.v.starts)
        groups = [(a, b, i, j) for a, b, i, j in zip(*(x.tolist() for x in (self.v.starts[:-1], self.v.starts[1:], edges[:-1], edges[1:])))
                  if b - a > 1 and j > i]
        return order if some is None else some[order], ids, self.classes[ids], groups

    def log_p(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of each target id after each state: its class, then the word in it."""
        return self.log_p_after(np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1), target)

    def log_p_after(self, states: np.ndarray, target: np.ndarray, outputs: tuple | None = None) -> np.ndarray:
        """``log_p`` of states with a last column of ones; ``outputs`` are this network's, if made before."""
        cw, ow, large = outputs or self.outputs()
        order, ids, of, groups = self._by_word(target)
        some, found = np.take(states, order, axis=0), np.empty(len(order), states.dtype)
        for i in range(0, len(order), BLOCK):
            found[i:i + BLOCK] = _picked(some[i:i + BLOCK] @ cw, of[i:i + BLOCK], large)
        for a, b, i, j in groups:
            found[i:j] += _picked(some[i:j] @ ow[:, a:b], ids[i:j] - a, large)
        out = np.empty_like(found)
        out[order] = found
        return out

    def loss_gradient(self, states: np.ndarray, target: np.ndarray, g: dict[str, np.ndarray], real: np.ndarray | None = None) -> np.ndarray:
        """Adds the output weights' gradients of the summed loss to ``g``; returns the states' gradient.

        States have a last column of ones. Those not in ``real`` have no loss.
        """
        w, d = self.w, self.hidden
        cw, ow, large = self.outputs()
        order, ids, of, groups = self._by_word(target, real)
        some, dsome = np.take(states, order, axis=0), np.empty((len(order), d), states.dtype)
        back, dcw = np.ascontiguousarray(w["cw"].T), np.zeros_like(cw)
        for i in range(0, len(order), BLOCK):
            dsome[i:i + BLOCK] = _gradient(some[i:i + BLOCK], cw, back, of[i:i + BLOCK], dcw, large)
        g["cw"] += dcw[:d]
        g["cb"] += dcw[d]
        dow = np.zeros_like(ow)
        for a, b, i, j in groups:
            dsome[i:j] += _gradient(some[i:j], ow[:, a:b], w["ow"][a:b], ids[i:j] - a, dow[:, a:b], large)
        g["ow"] += dow[:d].T
        g["ob"] += dow[d]
        out = np.zeros((len(target), d), states.dtype)
        out[order] = dsome
        return out

    def window(self, previous: np.ndarray, target: np.ndarray, fresh: np.ndarray, h: np.ndarray, g: dict[str, np.ndarray],
               real: np.ndarray | None = None) -> np.ndarray:
        """Forward and truncated backward over (steps, lanes); adds gradients to ``g`` and returns the last state.

        ``fresh`` marks steps that begin a document: the state before them is zero.
        ``real`` marks steps that hold a token, all by default: no other, at a lane's end, has a loss.
        Inside, lanes are columns, so that gates are contiguous; states go to the output weights as rows.
        """
        w, d, kind = self.w, self.hidden, self.flat.dtype
        steps, lanes = previous.shape
        e = w["x"].shape[1]
        given = np.empty((steps, e + 1 + d, lanes), kind)
        for k, unit in enumerate(np.ascontiguousarray(w["x"].T)):
            given[:, k] = unit.take(previous)
        given[:, e] = 1
        kept = np.empty((steps, 4 * d, lanes), kind)
        states = np.empty((steps, lanes, d + 1), kind)
        states[:, :, d] = 1
        begins = {int(t): np.flatnonzero(fresh[t]) for t in np.flatnonzero(fresh.any(axis=1))}
        forward, h = self.halved(), h.T
        for t in range(steps):
            before = given[t, e + 1:]
            before[:] = h
            if t in begins:
                before[:, begins[t]] = 0
            np.matmul(forward, given[t], out=kept[t])
            h = self.advance(kept[t], before)
            states[t, :, :d] = h.T
        dstates = self.loss_gradient(states.reshape(-1, d + 1), target.reshape(-1), g, None if real is None or real.all() else np.flatnonzero(real))
        dstates, dx = dstates.reshape(steps, lanes, d), np.empty((e, steps, lanes), kind)
        back, dunit, dh = np.ascontiguousarray(self.unit().T), np.zeros((4 * d, e + 1 + d), kind), np.zeros((d, lanes), kind)
        several = max(1, 4 * BLOCK // lanes)  # steps gone back over at once
        for end in range(steps, 0, -several):
            start = max(end - several, 0)
            part, before = kept[start:end], given[start:end, e + 1:]
            z, r, cand, rec = (part[:, i * d:(i + 1) * d] for i in range(4))
            # What a state's gradient is multiplied with on its way to both gates and the candidate's two parts.
            to = np.empty_like(part)
            to_z, to_r, to_cand, to_rec = (to[:, i * d:(i + 1) * d] for i in range(4))
            stay = 1 - z
            np.multiply(cand, cand, out=to_cand)
            np.subtract(1, to_cand, out=to_cand)
            to_cand *= z
            np.multiply(to_cand, r, out=to_rec)
            np.subtract(1, r, out=to_r)
            to_r *= rec
            to_r *= to_rec
            np.subtract(cand, before, out=to_z)
            to_z *= z
            to_z *= stay
            for t in range(end - 1, start - 1, -1):
                dh += dstates[t].T
                one = to[t - start]
                every = one.reshape(4, d, lanes)
                every *= dh
                dgiven = back @ one
                dx[:, t] = dgiven[:e]
                dh *= stay[t - start]
                dh += dgiven[e + 1:]
                if t in begins:
                    dh[:, begins[t]] = 0
                if lanes >= BLOCK // 4:
                    dunit[:3 * d, :e + 1] += one[:3 * d] @ given[t, :e + 1].T
                    dunit[:2 * d, e + 1:] += one[:2 * d] @ before[t - start].T
                    dunit[3 * d:, e + 1:] += one[3 * d:] @ before[t - start].T
            if lanes < BLOCK // 4:
                dunit += to.transpose(1, 0, 2).reshape(4 * d, -1) @ given[start:end].transpose(1, 0, 2).reshape(e + 1 + d, -1).T
        g["wx"] += dunit[:3 * d, :e].T
        g["b"] += dunit[:3 * d, e]
        g["wh"][:, :2 * d] += dunit[:2 * d, e + 1:].T
        g["wh"][:, 2 * d:] += dunit[3 * d:, e + 1:].T
        order, ids, _, _ = self._by_word(previous.reshape(-1))
        first = np.flatnonzero(np.diff(ids, prepend=-1))
        g["x"][ids[first]] += np.add.reduceat(np.take(dx.reshape(e, -1), order, axis=1), first, axis=1).T
        return h.T


def _picked(logits: np.ndarray, which: np.ndarray, large: bool) -> np.ndarray:
    """Log of the softmax over each row, at column ``which`` of it; overwrites ``logits``."""
    if large:
        logits -= logits.max(axis=1, keepdims=True)
    n, columns = logits.shape
    out = logits.reshape(-1).take(np.arange(0, n * columns, columns) + which)
    np.exp(logits, out=logits)
    return out - np.log(logits @ np.ones(columns, logits.dtype))


def _gradient(states: np.ndarray, weights: np.ndarray, back: np.ndarray, which: np.ndarray, g: np.ndarray, large: bool) -> np.ndarray:
    """Gradient for ``states`` of the loss of a softmax over columns of ``weights`` with targets ``which``; the
    weights' is added to ``g``. ``back`` holds the weights in rows, without the biases."""
    p = states @ weights
    if large:
        p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    n, columns = p.shape
    total = p @ np.ones(columns, p.dtype)
    p.reshape(-1)[np.arange(0, n * columns, columns) + which] -= total
    # Dividing by the total is left to the narrower sides of the products.
    share = np.reciprocal(total)[:, None]
    g += (states * share).T @ p
    out = p @ back
    out *= share
    return out


class Trainer:
    """Adam over a stream of documents laid out in lanes."""

    def __init__(self, network: Network, lanes: int = LANES, window: int = WINDOW, rate: float = RATE):
        self.net, self.lanes, self.window, self.rate = network, lanes, window, rate
        self.end = network.v.ids.get(b"", 0)
        self.queue: list[np.ndarray] = []
        self.lane = [(np.empty(0, np.int64), 0)] * lanes
        self.last = np.zeros(lanes, np.int64)  # ids before the next step
        self.h = np.zeros((lanes, network.hidden), np.float32)
        self.grad, self.m, self.s = (np.zeros_like(network.flat) for _ in range(3))
        self.updates = self.tokens = 0

    def add(self, document: np.ndarray) -> None:
        """A document's ids, its end included; whole windows are trained on as soon as all lanes have work."""
        self.queue.append(document)
        while len(self.queue) >= self.lanes:
            self._window()

    def finish(self) -> None:
        """Trains on what the queue and the lanes still hold, to each document's end."""
        while self.queue or any(done < len(document) for document, done in self.lane):
            self._window()

    def _window(self) -> None:
        """One update. Lanes that are left when others ran out of documents get longer windows, so
        that an update still rests on as many tokens and long documents at the end cost few of them."""
        rows, steps = list(range(self.lanes)), self.window
        if not self.queue:
            left = [len(document) - done for document, done in self.lane]
            rows = [lane for lane in rows if left[lane]]
            steps = min(max(left), max(steps, self.window * self.lanes // max(len(rows), 1)))
        filled, begins, parts, none = [], [], [], np.zeros(steps, np.int64)
        for row, lane in enumerate(rows):
            document, done = self.lane[lane]
            at = 0
            while at < steps:
                if done == len(document):
                    if not self.queue:
                        parts.append(none[at:])
                        break
                    document, done = self.queue.pop(), 0
                    begins.append(row * steps + at)
                part = document[done:done + steps - at]
                parts.append(part)
                done += len(part)
                at += len(part)
            self.lane[lane] = document, done
            filled.append(at)
        if not any(filled):
            return
        target, filled = np.concatenate(parts).reshape(-1, steps), np.array(filled)
        fresh = np.zeros(target.shape, bool)
        fresh.reshape(-1)[begins] = True
        previous = np.concatenate([self.last[rows][:, None], target[:, :-1]], axis=1)
        previous[fresh] = self.end
        real = np.arange(steps) < filled[:, None]
        some = np.flatnonzero(filled)  # the others ran out of documents
        rows = np.array(rows)[some]
        self.last[rows] = target[some, filled[some] - 1]
        previous, target, fresh, real = (np.ascontiguousarray(x[some].T) for x in (previous, target, fresh, real))
        self.grad[:] = 0
        self.h[rows] = self.net.window(previous, target, fresh, self.h[rows], self.net.views(self.grad), real)
        self.tokens += int(real.sum())
        self._update(1 / (self.window * self.lanes))  # a token weighs the same in a window that is not full

    def _update(self, scale: float) -> None:
        self.updates += 1
        norm = float(np.linalg.norm(self.grad)) * scale
        scale *= min(1.0, CLIP / max(norm, CLIP))
        to_m, to_s = self.rate / (1 - 0.9 ** self.updates), (1 - 0.999 ** self.updates) ** -0.5
        for i in range(0, len(self.grad), 1 << 14):  # a part at a time stays in the cache
            g, m, s = (x[i:i + (1 << 14)] for x in (self.grad, self.m, self.s))
            g *= scale
            m *= 0.9
            m += 0.1 * g
            g *= g
            g *= 0.001
            s *= 0.999
            s += g
            np.sqrt(s, out=g)
            g *= to_s
            g += 1e-8
            np.divide(m, g, out=g)
            g *= to_m
            self.net.flat[i:i + (1 << 14)] -= g


def _train(v: Vocabulary, start: np.ndarray):
    """One replica per task: its weights as one array, and how many tokens it saw."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trainer, inner = Trainer(Network(v, start)), pa.array([w.decode() for w in v.ids], pa.string())
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in byte_batches(texts):
                words, starts = words_of(texts[a:b])
                ids = _found(words, inner) + 1
                for i, j in zip(starts[:-1].tolist(), starts[1:].tolist()):
                    trainer.add(ids[i:j])
        trainer.finish()
        if trainer.tokens:
            yield pd.DataFrame({"weights": [trainer.net.flat.astype(np.float64).tolist()], "tokens": [trainer.tokens]})
    return run


def _mean(replicas: pd.DataFrame) -> pd.DataFrame:
    """The replicas' mean of one part of the weights, each weighted by its tokens."""
    weights = np.average(np.stack(replicas["weights"].tolist()), axis=0, weights=replicas["tokens"].to_numpy(np.float64))
    return pd.DataFrame({"part": replicas["part"].iloc[:1], "weights": [weights]})


def _found(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word stands in ``among``; -1 if it doesn't."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy().astype(np.int64)


@dataclass
class Model:
    """Counts and network. ``counts`` has every training word, ``known`` the most frequent
    with their counts, most frequent first: the network's own words lead it."""

    counts: DataFrame
    known: list[tuple[bytes, int]]
    total: int  # training tokens
    kinds: int  # distinct ones
    rare_total: int  # those outside the network's vocabulary
    rare_kinds: int
    network: Network

    @property
    def base_norm(self) -> float:
        return float(np.log10(self.total + 0.5 * (self.kinds + 1)))

    @property
    def rare_norm(self) -> float:
        return float(np.log10(self.rare_total + 0.5 * (self.rare_kinds + 1)))


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, ``most`` at most, in order of count and word.

    A histogram of counts, in sixteenths of powers of two, says from which
    count on there are few enough; only those words reach the driver.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    held, least = 0, None
    for at, words in sorted(map(tuple, sizes), reverse=True):
        if held + words > most:
            break
        held, least = held + words, at
    if least is None:
        return []
    return sorted(((r["word"].encode(), r["n"]) for r in counts.where(step >= least).collect()), key=lambda x: (-x[1], x[0]))


def fit(docs: DataFrame, text: str = "text", words: int = WORDS, rounds: int = ROUNDS) -> Model:
    """Counts over all tokens of all rows, and a network trained on all rows.

    To the driver come at most the KNOWN most frequent words and one weight
    vector a round; replicas are averaged by Spark, weighted by tokens. No rows leave
    a model that knows no word.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    counts = cut(count_words(texts))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("kinds")).first()
    top = frequent(counts, KNOWN)
    inner = top[:words - 1]
    rare_total = sums["n"] - sum(n for _, n in inner)
    v = vocabulary(inner, rare_total)
    network = Network(v)
    for _ in range(rounds):
        replicas = texts.mapInPandas(_train(v, network.flat), fields(weights="double[]", tokens="long"))
        mean = replicas.select("tokens", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("weights"), F.lit(PART)), lambda i: F.slice("weights", i, PART))).alias("part", "weights"))
        flat = [r["weights"] for r in mean.groupBy("part").applyInPandas(_mean, fields(part="int", weights="double[]")).orderBy("part").collect()]
        if flat:
            network = Network(v, np.concatenate(flat))
    return Model(counts, top, sums["n"], sums["kinds"], rare_total, sums["kinds"] - len(inner), network)


def network_scores(net: Network, documents: list[np.ndarray], lanes: int = SCORE_LANES, window: int = SCORE_WINDOW) -> np.ndarray:
    """Log10 probability of each whole id sequence; documents of like length run side by side.

    The state runs through a document step by step; nothing is cut off. Ids lie in order
    of steps, without gaps where shorter documents have ended. Output weights meet the states of
    as many steps at once as make about ``lanes`` * ``window`` of them. Memory holds CELLS ids, or one document.
    """
    out = np.zeros(len(documents))
    length = np.array([len(d) for d in documents], dtype=np.int64)
    order = np.argsort(-length, kind="stable")
    total = np.concatenate([[0], np.cumsum(length[order])])
    end, d = net.v.ids.get(b"", 0), net.hidden
    units, forward, outputs = np.ascontiguousarray(net.w["x"].T), net.halved(), net.outputs()
    e, kind = len(units), net.flat.dtype
    done = 0
    while done < len(order):
        most = int(np.searchsorted(total, total[done] + CELLS, side="right")) - 1 - done
        group = order[done:done + max(1, min(lanes, most))]
        done += len(group)
        size = length[group]  # falling
        longest = int(size[0])
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # documents that have such a step
        starts = np.concatenate([[0], np.cumsum(live)])
        ids = np.empty(starts[-1], dtype=np.int64)
        for lane, document in enumerate(group):
            ids[starts[:size[lane]] + lane] = documents[document]
        before = np.full(len(ids), end)
        for t in range(1, longest):
            before[starts[t]:starts[t + 1]] = ids[starts[t - 1]:starts[t - 1] + live[t]]
        h, sums, t = np.zeros((d, len(group)), kind), np.zeros(len(group)), 0
        while t < longest:
            upto = min(longest, max(t + 1, int(np.searchsorted(starts, starts[t] + lanes * window, side="right")) - 1))
            a, b = int(starts[t]), int(starts[upto])
            columns, states = np.empty((e + 1, b - a), kind), np.empty((b - a, d + 1), kind)
            for k in range(e):
                columns[k] = units[k].take(before[a:b])
            columns[e], states[:, d] = 1, 1
            for i, j, n in zip((starts[t:upto] - a).tolist(), (starts[t + 1:upto + 1] - a).tolist(), live[t:upto].tolist()):
                h = h[:, :n]
                h = net.advance(forward @ np.concatenate([columns[:, i:j], h]), h)
                states[i:j, :d] = h.T
            lane = np.arange(b - a) - np.repeat(starts[t:upto] - a, live[t:upto])
            sums += np.bincount(lane, weights=net.log_p_after(states, ids[a:b], outputs), minlength=len(group))
            t = upto
        out[group] = sums
    return out / np.log(10)


_PART = fields(n_tokens="long", n_known="long", n_rare="long", vocabulary_sum="double", rare_sum="double", net="double", others="string[]", times="long[]")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, base_score, score, and the columns of ``keep``.

    base_score is the smoothed unigram log10 probability of all tokens, score
    the model's. Null and empty texts are their end token alone, texts of any
    length are scored whole, an empty table gives no rows. Repeated
    rows are scored each. Other columns are left behind; those of ``keep`` must
    not be called like the result's. Words beyond the KNOWN ones are joined with their
    counts once per document and word; texts stay where they are.
    """
    net, known = model.network, model.known

    @F.pandas_udf(_PART)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        among = pa.array([w.decode() for w, _ in known], pa.string())
        value = np.log10(np.array([*(n for _, n in known), 0.0]) + 0.5)
        value[-1] = 0.0  # of words that are joined later
        inside = np.zeros(len(known) + 1, dtype=np.int64)
        inside[:net.v.size - 1] = np.arange(1, net.v.size)  # the network's words lead the known ones
        for batch in batches:
            texts, rows = batch.tolist(), []
            for a, b in byte_batches(texts, TEXTS):
                words, starts = words_of(texts[a:b])
                at = _found(words, among)
                ids, found, others = inside[at], value[at], np.flatnonzero(at < 0)
                rare = ids == 0
                # No text is without a word, as each has its end: every sum is over some.
                n_rare, vocabulary_sum, rare_sum = (np.add.reduceat(x, starts[:-1]) for x in (
                    rare.astype(np.int64), np.where(rare, 0.0, found), np.where(rare, found, 0.0)))
                scores = network_scores(net, [ids[i:j] for i, j in zip(starts[:-1], starts[1:])])
                names, edges = words.take(pa.array(others)).to_pylist(), np.searchsorted(others, starts).tolist()
                for i, n in enumerate(np.diff(starts).tolist()):
                    rest = Counter(names[edges[i]:edges[i + 1]])
                    rows.append((n, n - rest.total(), int(n_rare[i]), float(vocabulary_sum[i]), float(rare_sum[i]), float(scores[i]),
                                 list(rest), list(rest.values())))
            yield pd.DataFrame(rows, columns=_PART.names)

    extra = keep or {}
    row = F.monotonically_increasing_id()
    parts = docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("doc_id"), *[c.alias(k) for k, c in extra.items()], run(F.col(f"`{text}`")).alias("p"))
    # Every document sends its words to be looked up and, as a word that none can be
    # (it has a blank) and so found nowhere, itself: the texts are scored once, nothing is joined back.
    own = ["doc_id", *extra, *[x for x in _PART.names if x not in ("others", "times")]]
    itself = F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).alias("word"), F.lit(0).cast("long").alias("times"))
    words = F.concat(F.array(itself), F.arrays_zip(F.col("p.others").alias("word"), F.col("p.times").alias("times")))
    asked = parts.select("row", "doc_id", *extra, "p", F.posexplode(words).alias("nth", "o")).select(
        "row", "o.word", "o.times",
        *[F.when(F.col("nth") == 0, F.col(f"p.{x}" if x in _PART.names else x)).alias(x) for x in own])
    looked = asked.join(model.counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    all_ = looked.groupBy("row").agg(
        *[F.max(x).alias(x) for x in own], F.sum(F.col("times") * F.log10(F.col("n") + 0.5)).alias("other_sum"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("other_known"))
    rare_sum = F.col("rare_sum") + F.col("other_sum")
    return all_.select(
        "doc_id", *extra, "n_tokens", (F.col("n_known") + F.col("other_known")).alias("n_known"),
        (F.col("vocabulary_sum") + rare_sum - F.col("n_tokens") * F.lit(model.base_norm)).alias("base_score"),
        (F.col("net") + rare_sum - F.col("n_rare") * F.lit(model.rare_norm)).alias("score"))
