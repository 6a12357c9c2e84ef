"""SentencePiece encoding with n-best segmentations, and decoding.

The piece lattice of a text has an edge for each vocabulary piece at each place. Forward Viterbi
gives every place the best score of the text before it. From the end, A-star search extends partial
segmentations backward; since the Viterbi scores are exact, it meets complete segmentations in order
of their scores and visits little more than these.

A text is cut where no piece of the vocabulary spans the cut, which changes no segmentation: the n best
of the whole follow from the n best of the cuts. Cuts repeat, so workers keep a bounded table of them. Only
in the n - 1 cuts whose second best loses least can one of the n best depart from the best, so the forward
pass finds the two best scores of each cut, and the search runs in those cuts alone.

A space is put first, as the model's format asks, and U+2581 in its pieces is read as a space. A character
without a piece of its own gets an edge at the lowest score less 10, which emits its UTF-8 bytes as byte
pieces. So does U+2581 in the text itself, and decoding returns every text exactly.

Defined cases: null and empty texts have one segmentation, without pieces, with score 0; fewer than n
segmentations give as many as there are; of equal scores the order is that of the search, which is the
same in every run; null doc_ids and repeated rows are encoded like others; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import chain
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wicketflow.llm.common import Recent

NBEST = 3
_CACHED = 250_000
_SPACE = "▁"
_NEAR = 0x500

Segmentation = tuple[float, tuple[int, ...]]


class Cut:
    """One part of a text: its best segmentation with its score, what the second best loses, and, once they are
    wanted, the n best.

    `names` are the ids as decimal numbers joined by spaces, `read` what they decode to; both are kept only for digests.
    """

    __slots__ = ("ids", "loss", "names", "ranked", "read", "score", "size", "text")

    def __init__(self, text: str, score: float, loss: float, ids: tuple[int, ...], names: bytes | None, read: bytes | None):
        self.text, self.score, self.loss, self.ids = text, score, loss, ids
        self.size, self.names, self.read, self.ranked = len(ids), names, read, None


def choices(parts: list[Cut], n: int, search) -> list[tuple[float, dict[int, int]]]:
    """Scores of the n best choices of one segmentation per part, and where they depart from the best.

    `search(part)` gives the n best of a part.

    A choice that departs in a part outside the n - 1 with the least loss has n choices before it, so
    only these parts are searched.
    """
    losses = [p.loss for p in parts]
    base = sum([p.score for p in parts])
    open_ = [k for k in heapq.nsmallest(n - 1, range(len(parts)), key=losses.__getitem__) if losses[k] < inf]
    loss = [[parts[k].score - s for s, _ in search(parts[k])] for k in open_]
    start = (0,) * len(open_)
    heap, seen, out = [(0.0, start)], {start}, []
    while heap and len(out) < n:
        lost, choice = heapq.heappop(heap)
        out.append((base - lost, {k: c for k, c in zip(open_, choice) if c}))
        for j, c in enumerate(choice):
            if c + 1 < len(loss[j]):
                step = (*choice[:j], c + 1, *choice[j + 1 :])
                if step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (lost - loss[j][c] + loss[j][c + 1], step))
    return out


def joined(parts: list[Cut], departs: dict[int, int]) -> tuple[int, ...]:
    ids = [p.ids for p in parts]
    for k, c in departs.items():
        ids[k] = parts[k].ranked[c][1]
    return tuple(chain.from_iterable(ids))


class PieceModel:
    def __init__(self, path: str, cached: int = _CACHED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.octets: list[bytes] = []
        byte_ids: dict[int, int] = {}
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte_ids[int(piece[3:5], 16)] = k
                self.octets.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                self.octets.append(b"")
            else:
                spaced = piece.replace(_SPACE, " ")
                self.pieces[spaced] = (k, model.get_score(k))
                self.octets.append(spaced.encode())
        # A tree of the pieces' characters: by character, what follows and the piece that ends there, as ids and score.
        self.tree: dict[str, list] = {}
        for piece, (k, score) in self.pieces.items():
            following = self.tree
            for c in piece:
                node = following.setdefault(c, [{}, None])
                following = node[0]
            node[1] = ((k,), score)
        # Neighbouring characters that some piece joins, as one number per pair: a small table for the
        # first characters of Unicode, a sorted list for all others.
        pairs = {(ord(p[k]), ord(p[k + 1])) for p in self.pieces for k in range(len(p) - 1)}
        self.near = np.zeros((_NEAR, _NEAR), bool)
        for x, y in pairs:
            if x < _NEAR and y < _NEAR:
                self.near[x, y] = True
        self.far = np.array(sorted((x << 21) | y for x, y in pairs), np.int64)
        self.byte_ids = [byte_ids[k] for k in range(256)]
        self.names = [b"%d" % k for k in range(len(self.octets))]
        self.fallback = min(s for _, s in self.pieces.values()) - 10
        self.cached = cached
        self.tables: dict[tuple[int, bool], Recent] = {}

    def lattice(self, text: str):
        """For each place the pieces that end there (start, score, ids), and the best score up to it."""
        size, tree, low = len(text), self.tree, -inf
        ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        best = [0.0] + [low] * size
        for a in range(size):
            so_far, node, b = best[a], tree, a
            for c in text[a:]:
                step = node.get(c)
                if step is None:
                    break  # no piece starts like this
                b += 1
                node, found = step
                if found is not None:
                    ids, score = found
                    ending[b].append((a, score, ids))
                    if so_far + score > best[b]:
                        best[b] = so_far + score
            if not (ending[a + 1] and ending[a + 1][-1][0] == a):
                ending[a + 1].append((a, self.fallback, tuple([self.byte_ids[o] for o in text[a].encode()])))
                best[a + 1] = max(best[a + 1], so_far + self.fallback)
        return ending, best

    def two_best(self, text: str) -> tuple[float, float, tuple[int, ...]]:
        """Scores of the best and the second best segmentation of an escaped text (-inf if there is one only), ids of the best."""
        size, tree, low = len(text), self.tree, -inf
        best, second = [0.0] + [low] * size, [low] * (size + 1)
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (size + 1)
        for a in range(size):
            first, next_, node, b, alone = best[a], second[a], tree, a, False
            for c in text[a:]:
                step = node.get(c)
                if step is None:
                    break
                b += 1
                node, found = step
                if found is not None:
                    ids, score = found
                    alone = alone or b == a + 1
                    total = first + score
                    if total > best[b]:
                        second[b] = max(best[b], next_ + score)
                        best[b], back[b] = total, (a, ids)
                    elif total > second[b]:
                        second[b] = total
            if not alone:
                b, total = a + 1, first + self.fallback
                if total > best[b]:
                    second[b] = max(best[b], next_ + self.fallback)
                    best[b], back[b] = total, (a, tuple([self.byte_ids[o] for o in text[a].encode()]))
                elif total > second[b]:
                    second[b] = total
        path, at = [], size
        while at:
            at, ids = back[at]
            path.append(ids)
        return best[size], second[size], tuple(chain.from_iterable(path[::-1]))

    def search(self, text: str, n: int) -> list[Segmentation]:
        """The n best segmentations of an escaped text: forward Viterbi, then backward A-star.

        Each open hypothesis stands for at least one segmentation with exactly its score, so no more of
        them are kept than segmentations are still wanted. Of equal scores the latest goes first, so
        ties are followed to their end.
        """
        ending, best = self.lattice(text)
        open_ = [(best[-1], len(text), 0.0, None)]  # ascending by score
        out: list[Segmentation] = []
        while open_:
            _, place, after, link = open_.pop()
            if place == 0:
                ids: list[int] = []
                while link is not None:
                    ids += link[0]
                    link = link[1]
                out.append((after, tuple(ids)))
                if len(out) == n:
                    break
                continue
            wanted = n - len(out)
            for a, s, ids in ending[place]:
                total = best[a] + s + after
                if len(open_) >= wanted:
                    if total <= open_[0][0]:
                        continue
                    del open_[0]
                k = len(open_)
                while k and open_[k - 1][0] > total:
                    k -= 1
                open_.insert(k, (total, a, s + after, (ids, link)))
        return out

    def _places(self, text: str) -> list[int]:
        """Where a text can be cut: between characters that no piece joins."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        left, right = codes[:-1], codes[1:]
        small = (left < _NEAR) & (right < _NEAR)
        joined_ = self.near[np.minimum(left, _NEAR - 1), np.minimum(right, _NEAR - 1)]
        odd = np.flatnonzero(~small)
        if len(odd):
            pairs = (left[odd].astype(np.int64) << 21) | right[odd]
            at = np.minimum(np.searchsorted(self.far, pairs), len(self.far) - 1)
            joined_[odd] = self.far[at] == pairs
        return (np.flatnonzero(~joined_) + 1).tolist()

    def ranked(self, cut: Cut, n: int) -> list[Segmentation]:
        if cut.ranked is None:
            cut.ranked = self.search(cut.text, n)
        return cut.ranked

    def cuts(self, text: str, n: int, told: bool = False) -> list[Cut]:
        """A text that is not empty, as parts whose segmentations don't depend on each other; with names and readings if `told`."""
        table = self.tables.get((n, told))
        if table is None:
            table = self.tables[n, told] = Recent(self.cached)
        table.turn()
        escaped = " " + text
        places = self._places(escaped)
        out = []
        for a, b in zip([0, *places], [*places, len(escaped)]):
            piece = escaped[a:b]
            cut = table.get(piece) or table.recall(piece)
            if cut is None:
                cut = table[piece] = self._cut(piece, n, told)
            out.append(cut)
        return out

    def _cut(self, piece: str, n: int, told: bool) -> Cut:
        score, next_, ids = self.two_best(piece)
        ranked = None
        if score == next_:  # of equal scores the search decides which comes first
            ranked = self.search(piece, n)
            ids = ranked[0][1]
        names, read = (self.named(ids), self.read(ids)) if told else (None, None)
        cut = Cut(piece, score, score - next_, ids, names, read)
        cut.ranked = ranked
        return cut

    def _choices(self, parts: list[Cut], n: int) -> list[tuple[float, dict[int, int]]]:
        return choices(parts, n, lambda cut: self.ranked(cut, n))

    def nbest(self, text: str | None, n: int = NBEST) -> list[Segmentation]:
        if not text:
            return [(0.0, ())]
        parts = self.cuts(text, n)
        return [(s, joined(parts, d)) for s, d in self._choices(parts, n)]

    def nbest_scores(self, text: str | None, n: int = NBEST) -> tuple[tuple[int, ...], list[float]]:
        """Ids of the best segmentation, scores of the n best."""
        if not text:
            return (), [0.0]
        parts = self.cuts(text, n)
        return joined(parts, {}), [s for s, _ in self._choices(parts, n)]

    def nbest_digests(self, text: str | None, n: int = NBEST) -> list[tuple[float, int, str, bytes]]:
        """Of the n best: score, number of ids, SHA-256 of the ids joined by spaces, the text that the ids decode to.

        All is joined from what the parts keep; the others are the best with the parts that depart put in.
        """
        if not text:
            return [(0.0, 0, hashlib.sha256(b"").hexdigest(), b"")]
        parts = self.cuts(text, n, told=True)
        names, reads, size = [p.names for p in parts], [p.read for p in parts], sum([p.size for p in parts])
        best = b"".join(reads)[1:]
        out = []
        for score, departs in self._choices(parts, n):
            own, read, more = names, best, 0
            if departs:
                own, other = names.copy(), {}
                for k, c in departs.items():
                    ids = parts[k].ranked[c][1]
                    own[k], other[k], more = self.named(ids), self.read(ids), more + len(ids) - parts[k].size
                if any(reads[k] != r for k, r in other.items()):
                    read = b"".join([other.get(k, r) for k, r in enumerate(reads)])[1:]
            out.append((score, size + more, hashlib.sha256(b" ".join(own)).hexdigest(), read))
        return out

    def named(self, ids) -> bytes:
        return b" ".join(map(self.names.__getitem__, ids))

    def read(self, ids) -> bytes:
        return b"".join(map(self.octets.__getitem__, ids))

    def decode(self, ids) -> str:
        return self.read(ids)[1:].decode()


@cache
def piece_model(path: str) -> PieceModel:
    """One per Python worker; workers are used for many tasks."""
    return PieceModel(path)


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("score", pa.float64()), ("scores", pa.list_(pa.float64())),
    ("alternatives", pa.list_(pa.list_(pa.int32()))), ("decoded", pa.string()),
])


def _encode(path: str, n: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            # Few documents at a time: their ids are lists of numbers here, n of them for each.
            step = 32 if keep else 128
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                texts = part.column("text").to_pylist()
                if keep:
                    found = [model.nbest(t, n) for t in texts]
                    best, scores = [f[0][1] for f in found], [[s for s, _ in f] for f in found]
                    others = [[i for _, i in f[1:]] for f in found]
                else:
                    best, scores = zip(*[model.nbest_scores(t, n) for t in texts])
                    others = [None] * len(texts)
                offsets = np.concatenate([[0], np.cumsum([len(b) for b in best])]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(best), np.int32, int(offsets[-1]))
                columns = [
                    part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array([s[0] for s in scores], pa.float64()), pa.array(scores, pa.list_(pa.float64())),
                    pa.array(others, pa.list_(pa.list_(pa.int32()))), pa.array([model.decode(b) for b in best]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    return run


def encode_nbest(docs: DataFrame, model: str, n: int = NBEST, alternatives: bool = False) -> DataFrame:
    """doc_id, ids and score of the best segmentation, scores of the n best, decoded (ids read back as text).

    With `alternatives` the ids of the others too; they take n - 1 times the room of the first.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = narrow.mapInArrow(
        _encode(model, n, alternatives),
        "doc_id bigint, ids array<int>, score double, scores array<double>, alternatives array<array<int>>, decoded string",
    )
    return out if alternatives else out.drop("alternatives")


_RANK = "score double, n_pieces bigint, ids_sha256 string, decodes boolean"


def _summarise(path: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        rank = pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()), ("decodes", pa.bool_())])
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                part = batch.slice(k, 128)
                ranks, digests, lengths = [], [], []
                for text in part.column("text").to_pylist():
                    found, given = model.nbest_digests(text, n), (text or "").encode()
                    ranks.append([(*rest, read == given) for *rest, read in found])
                    digests.append(hashlib.sha256(found[0][3]).hexdigest())
                    lengths.append(len(found[0][3].decode()))
                columns = [part.column("doc_id"), pa.array(ranks, pa.list_(rank)), pa.array(digests), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "segmentations", "decoded_sha256", "decoded_chars"])

    return run


def summarise(docs: DataFrame, model: str, n: int = NBEST) -> DataFrame:
    """Per document: doc_id; n_pieces, score and ids_sha256 (ids joined by spaces) of the best segmentation; scores of the
    n best; decoded_sha256, n_chars of the decoded text; segmentations: for each of the n best, in order, score, n_pieces,
    ids_sha256, and whether its ids decode to the text."""
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    done = narrow.mapInArrow(
        _summarise(model, n), f"doc_id bigint, segmentations array<struct<{_RANK}>>, decoded_sha256 string, decoded_chars bigint"
    )
    best = F.col("segmentations")[0]
    return done.select(
        "doc_id", best["n_pieces"].alias("n_pieces"), best["score"].alias("score"), F.col("segmentations.score").alias("scores"),
        best["ids_sha256"].alias("ids_sha256"), "decoded_sha256", "decoded_chars", "segmentations",
    )
