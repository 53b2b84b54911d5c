"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import cut, share, taken

#: A word begins with a letter and goes on with letters and the marks on them.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
WIDE = 24
BUCKETS = 1 << 17
#: Words of a block; the messages of a longer chain go from block to block.
BLOCK = 64


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _codes(words: list[str], wide: int) -> np.ndarray:
    """Code points of words of at most wide - 2 letters, a row each, with 1 before and 2 after."""
    flat = np.array([f"\x01{w}\x02" for w in words], f"U{wide}")
    return flat.view(np.uint32).reshape(len(words), wide).astype(np.uint64)


def _slot(kind: int, *codes: np.ndarray) -> np.ndarray:
    h = np.full(codes[0].shape, kind * 0x9E3779B1 + 1, np.uint64)
    for c in codes:
        h = (h ^ c) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
    return h


def word_features(words: list[str], lexicon: np.ndarray, wide: int = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of the features of each word: beginnings and ends, 2- and 3-grams, the word itself if known."""
    c = _codes(words, wide)
    n, length = len(words), (c > 0).sum(axis=1)
    row = np.arange(n)
    at = lambda k: c[row, np.maximum(length - k, 0)]
    affixes = [_slot(1, c[:, 1]), _slot(2, c[:, 1], c[:, 2]), _slot(3, c[:, 1], c[:, 2], c[:, 3]), _slot(4, at(2)), _slot(5, at(3), at(2)), _slot(6, at(4), at(3), at(2))]
    pairs, triples = _slot(7, c[:, :-1], c[:, 1:]), _slot(8, c[:, :-2], c[:, 1:-1], c[:, 2:])
    slots = np.concatenate([np.stack(affixes, axis=1), pairs, triples], axis=1) % np.uint64(BUCKETS)
    even = (1 / np.sqrt(np.maximum(length, 1)))[:, None]
    values = np.concatenate([np.ones((n, len(affixes))), (c[:, 1:] > 0) * even, (c[:, 2:] > 0) * even], axis=1)
    own = word_hashes(words)
    place = np.searchsorted(lexicon, own)
    known = (place < len(lexicon)) & (lexicon[np.minimum(place, max(0, len(lexicon) - 1))] == own) if len(lexicon) else np.zeros(n, bool)
    slots = np.concatenate([slots.astype(np.int64), (BUCKETS + np.where(known, place, 0))[:, None]], axis=1)
    return slots, np.concatenate([values, known[:, None]], axis=1).astype(np.float32)


def feature_groups(words: list[str], lexicon: np.ndarray, step: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions, slots and values of all words, those of like width together: long words have more n-grams, and a table of their own."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = WIDE * 2 ** np.ceil(np.log2(np.maximum(1, (size + 2) / WIDE))).astype(np.int64)
    for wide in np.unique(width).tolist():
        those = np.flatnonzero(width == wide)
        for at in range(0, len(those), some := max(1, step * WIDE // wide)):
            part = those[at : at + some]
            yield part, *word_features([words[i] for i in part.tolist()], lexicon, wide)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def forward_backward(emit: np.ndarray, length: np.ndarray, move: np.ndarray, enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of labels (chains, places, labels) and of label pairs (summed), and the log of the partition sums.

    emit are scores, move the scores of transitions. All chains advance together; each place is scaled to sum 1.
    Places from a chain's length on have marginals 0. For a part of a longer chain, enter is what the words
    before say about the label of the first place and leave what those after say about that of the last.
    """
    n, t, k = emit.shape
    real = np.arange(t)[None, :] < length[:, None]
    top = emit.max(axis=2, keepdims=True)
    e, m = np.exp(emit - top), np.exp(move)
    ahead, back = np.empty_like(e), np.ones_like(e)
    if leave is not None:
        back[np.arange(n), np.maximum(length - 1, 0)] = leave
    scale = np.ones((n, t), e.dtype)
    a = np.full((n, k), 1 / k, e.dtype) if enter is None else enter
    for i in range(t):
        a = (a if i == 0 else a @ m) * e[:, i]
        scale[:, i] = a.sum(axis=1)
        a = a / scale[:, i : i + 1]
        ahead[:, i] = a
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        b = e[:, i + 1] * back[:, i + 1] / scale[:, i + 1 : i + 2]
        on = real[:, i + 1]
        pairs += (ahead[on, i].T @ b[on]) * m
        back[:, i] = np.where(on[:, None], b @ m.T, back[:, i])
    marginal = ahead * back * real[:, :, None]
    if leave is not None:
        marginal /= np.maximum(marginal.sum(axis=2, keepdims=True), 1e-30)
    return marginal, pairs, float(((np.log(scale) + top[:, :, 0]) * real).sum())


def block_messages(emit: np.ndarray, length: np.ndarray, move: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """enter and leave, for forward_backward, of blocks that make up longer chains: nth is the place of each in its chain.

    First every block's matrix, from the label before it to that of its last place, all blocks together; then
    vectors through the blocks of all chains, one place in the chain after the other.
    """
    n, t, k = emit.shape
    e, m = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(move)
    enter, leave = np.full((n, k), 1 / k, e.dtype), np.ones((n, k), e.dtype)
    last = np.append(nth[1:] == 0, True)
    some = np.flatnonzero((nth > 0) | ~last)  # blocks of chains of several
    whole = np.broadcast_to(np.eye(k, dtype=e.dtype), (len(some), k, k)).copy()
    for i in range(t):
        on = i < length[some]
        now = (whole[on] @ m if i else np.where((nth[some][on] > 0)[:, None, None], m, np.eye(k, dtype=e.dtype))) * e[some[on], i][:, None, :]
        whole[on] = now / now.sum(axis=(1, 2), keepdims=True)
    place = np.zeros(n, np.int64)
    place[some] = np.arange(len(some))
    by = np.argsort(nth, kind="stable")
    bounds = np.searchsorted(nth[by], np.arange(nth.max(initial=0) + 2))
    out = np.zeros((n, k), e.dtype)
    for d in range(len(bounds) - 1):
        here = by[bounds[d] : bounds[d + 1]]
        if d:
            enter[here] = out[here - 1] @ m
            enter[here] /= enter[here].sum(axis=1, keepdims=True)
        here = here[~last[here]]
        if len(here):
            v = np.einsum("nk,nkl->nl", out[here - 1] if d else np.full((len(here), k), 1 / k, e.dtype), whole[place[here]])
            out[here] = v / v.sum(axis=1, keepdims=True)
    for d in range(len(bounds) - 2, 0, -1):
        here = by[bounds[d] : bounds[d + 1]]
        v = np.einsum("nkl,nl->nk", whole[place[here]], leave[here])
        leave[here - 1] = v / v.sum(axis=1, keepdims=True)
    return enter, leave


@dataclass
class Chain:
    """A trained field: weights of features (BUCKETS and then the lexicon) and of transitions, by language."""

    langs: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    move: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.langs)), np.float32)
        for part, slots, values in feature_groups(words, self.lexicon):
            out[part] = np.einsum("nfk,nf->nk", self.weights[slots], values)
        return out


def train(windows: list[tuple[str, list[str]]], rounds: int = 60, decay: float = 1e-4) -> Chain:
    """Fits the field to windows of words of one language each, joined in turn to chains of two languages.

    Half of the chains switch language half way, so that the transitions learn that switches happen and are
    rare. Full gradients by forward-backward, with steps scaled by their own history (Adagrad).
    """
    langs = sorted({lang for lang, _ in windows})
    label = {x: i for i, x in enumerate(langs)}
    chains = [(w, [label[lang]] * len(w)) for lang, w in windows]
    order = np.random.default_rng(7).permutation(len(windows))
    for a, b in zip(order[::2].tolist(), order[1::2].tolist()):
        (la, wa), (lb, wb) = windows[a], windows[b]
        chains.append((wa[: len(wa) // 2] + wb[len(wb) // 2 :], [label[la]] * (len(wa) // 2) + [label[lb]] * (len(wb) - len(wb) // 2)))
    types: dict[str, int] = {}
    for w, _ in chains:
        for x in w:
            types.setdefault(x, len(types))
    vocabulary = list(types)
    seen = np.bincount([types[x] for _, w in windows for x in w], minlength=len(types))
    lexicon = np.unique(word_hashes([x for x, c in zip(vocabulary, seen) if c > 1]))
    groups = list(feature_groups(vocabulary, lexicon, len(vocabulary)))
    n, t, k = len(chains), max(len(w) for w, _ in chains), len(langs)
    length = np.array([len(w) for w, _ in chains])
    token, truth = np.zeros((n, t), np.int64), np.zeros((n, t), np.int64)
    for i, (w, y) in enumerate(chains):
        token[i, : len(w)], truth[i, : len(w)] = [types[x] for x in w], y
    real = np.arange(t)[None, :] < length[:, None]
    gold = np.eye(k)[truth] * real[:, :, None]
    both = real[:, 1:]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (truth[:, :-1][both], truth[:, 1:][both]), 1)
    weights, move = np.zeros((BUCKETS + len(lexicon), k), np.float32), np.zeros((k, k))
    past_w, past_m = np.full(weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    used = np.unique(np.concatenate([slots.ravel() for _, slots, _ in groups]))
    places = [np.searchsorted(used, slots).ravel() for _, slots, _ in groups]
    score = np.empty((len(types), k), np.float32)
    for r in range(rounds):
        for part, slots, values in groups:
            score[part] = np.einsum("nfk,nf->nk", weights[slots], values)
        marginal, pairs, _ = forward_backward(score[token].astype(float), length, move)
        rest = (gold - marginal)[real]
        by_type = np.stack([np.bincount(token[real], rest[:, c], len(types)) for c in range(k)], axis=1)
        g = np.zeros((len(used), k))
        for (part, _, values), place in zip(groups, places):
            for c in range(k):
                g[:, c] += np.bincount(place, (values * by_type[part, c : c + 1]).ravel(), len(used))
        g = (g / real.sum() - decay * weights[used]).astype(np.float32)
        h = (gold_pairs - pairs) / real.sum() - decay * move
        past_w[used] += g * g
        past_m += h * h
        weights[used] += 0.3 * g / np.sqrt(past_w[used])
        move += 0.1 * h / np.sqrt(past_m)
    return Chain(langs, lexicon, weights, move.astype(np.float32))


def _windows(batches: Iterable[pa.RecordBatch], wide: int, each: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, out, rank = batch.column(0), [], batch.column(2)
        for k, x in enumerate(batch.column(1)):
            words = words_of(x.as_py())
            last = max(0, len(words) - wide)
            for at in sorted({last * i // max(1, each - 1) for i in range(each)} if words else ()):
                out.append((lang[k].as_py(), " ".join(words[at : at + wide]), rank[k].as_py()))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.string(), pa.string(), pa.int64()])], names=["lang", "words", "rank"])


def fit(docs: DataFrame, learn: Column, most: int = 240, each: int = 3, wide: int = 48, languages: int = 512) -> Chain | None:
    """A field learnt from the text and non-null lang of the rows of docs for which `learn` holds; None if there are none.

    The sample is bounded: of each language at most `most` different texts, those of the least hashes, however
    often a text or another language occurs; of each text `each` windows of `wide` words spread over all of it.
    A field of more than `languages` languages is refused, as its tables would not fit.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("rank"))
    different = known.groupBy("lang", "rank").agg(F.count("*").alias("n"))
    counts = different.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages + 1).collect()
    if not counts:
        return None
    if len(counts) > languages:
        raise ValueError(f"more than {languages} languages to learn")
    # A hash below `top` has a language's share of twice the wanted; texts it has few of are all below.
    top = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r[0], int(min(1.0, 2.0 * most / r[1]) * (1 << 52)))]), F.col("lang"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("rank"))
    chosen = cut(different.where(F.pmod("rank", F.lit(1 << 52)) <= top).select("lang", "rank", nth.alias("nth")).where(F.col("nth") <= most).select("lang", "rank"))
    texts = known.join(chosen, ["lang", "rank"]).groupBy("lang", "rank").agg(F.min("text").alias("text")).select("lang", "text", "rank")
    rows = texts.mapInArrow(lambda b: _windows(b, wide, each), "lang string, words string, rank long").orderBy("rank", "lang", "words").collect()
    return train([(r[0], r[1].split(" ")) for r in rows]) if rows else None


class Reader:
    """Applies a field to texts; the emissions of words are kept while there are at most `most` of them."""

    def __init__(self, chain: Chain, most: int = 400_000):
        self.chain, self.most, self.place = chain, most, {}
        self.emission = np.empty((0, len(chain.langs)), np.float32)
        self.fresh: list[np.ndarray] = []

    def read(self, texts: list[str | None]) -> list[tuple[str, float, int, int]]:
        """lang, score, words, switches of each text."""
        out: list[tuple[str, float, int, int]] = [("und", 0.0, 0, 0)] * len(texts)
        start, held = 0, []
        size = 0
        for i, x in enumerate(texts):
            held.append(words_of(x))
            size += len(held[-1])
            if size >= 200_000 or i + 1 == len(texts):
                out[start : i + 1] = self._some(held)
                start, held, size = i + 1, [], 0
        return out

    def _some(self, docs: list[list[str]]) -> list[tuple[str, float, int, int]]:
        if len(self.place) > self.most:
            self.place, self.emission = {}, self.emission[:0]
        place, first = self.place, len(self.place)
        token = np.array([place.setdefault(w, len(place)) for words in docs for w in words], np.int64)
        if len(place) > first:
            fresh = list(place)[first:] if first else list(place)
            self.emission = np.concatenate([self.emission, self.chain.emissions(fresh)])
        n = np.array([len(d) for d in docs], np.int64)
        if not len(token):
            return [("und", 0.0, 0, 0)] * len(docs)
        offset = np.concatenate(([0], np.cumsum(n)))
        blocks = -(-n // BLOCK)
        owner = np.repeat(np.arange(len(docs)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(blocks)[:-1])), blocks)
        begin = offset[owner] + nth * BLOCK
        length = np.minimum(BLOCK, offset[owner + 1] - begin)
        at = np.minimum(begin[:, None] + np.arange(BLOCK)[None, :], len(token) - 1)
        emit = self.emission[token[at]]
        marginal, _, _ = forward_backward(emit, length, self.chain.move, *block_messages(emit, length, self.chain.move, nth))
        total = np.zeros((len(docs), len(self.chain.langs)))
        np.add.at(total, owner, marginal.sum(axis=1))
        best = marginal.argmax(axis=2)
        turn = (best[:, 1:] != best[:, :-1]) & (np.arange(1, BLOCK)[None, :] < length[:, None])
        turns = np.bincount(owner, turn.sum(axis=1), len(docs))
        over = np.flatnonzero(nth > 0)  # a turn from the end of one block, always full, to the next
        turns = (turns + np.bincount(owner[over], best[over, 0] != best[over - 1, -1], len(docs))).astype(int)
        lang = total.argmax(axis=1)
        share = total[np.arange(len(docs)), lang] / np.maximum(n, 1)
        return [(self.chain.langs[k], float(min(1.0, s)), int(m), int(t)) if m else ("und", 0.0, 0, 0) for k, s, m, t in zip(lang.tolist(), share.tolist(), n.tolist(), turns.tolist())]


def with_language(docs: DataFrame, chain: Chain | None, into: str = "language") -> DataFrame:
    """docs and a column of lang (the one with the highest summed word marginals), score (their mean), words and switches.

    Whole texts are read, each as one chain whatever its length. A text that is null or has no letter is `und`
    with score 0, as is every text without a field; of languages with the same sum the first in order counts. Rows
    are judged where they lie, so ids, repeated rows and other columns don't matter; an empty table stays empty; a
    column called as `into` is replaced.
    """
    kind = "struct<lang:string,score:double,words:bigint,switches:bigint>"
    if chain is None:
        return docs.withColumn(into, F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("switches")))
    shared = share(docs.sparkSession, chain)

    @F.pandas_udf(kind)
    def judge(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(taken(shared))
        for texts in series:
            yield pd.DataFrame(reader.read(list(texts)), columns=["lang", "score", "words", "switches"])

    return docs.withColumn(into, judge(docs["text"]))
