"""SentencePiece encoding and decoding with exact N-best segmentation.

The pieces that a text can be cut into form a lattice whose edges carry the pieces' scores.  Viterbi
goes forward and gives the best score of every prefix.  Backward A* search starts at the
end of the text with these scores as its heuristic: they are exact, so that hypotheses leave the queue
in the order of their total scores, and the first N that reach the start are the N best.

No piece of the model goes on after a blank mark that follows another character, and none holds a
line break.  So a text falls into segments (blank marks and the word after them) that no piece
crosses, its lattice is the chain of theirs, and a segment's N best are found once and
remembered for a bounded number of segments.  The N best of a text change its best path in at most
the N - 1 segments whose second segmentation costs least; the same search combines them.

Characters without a piece are their UTF-8 bytes.  So is a blank mark that stands in the
text itself, which makes decoding exact.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from sluice.llm.batches import slices, texts_of

N_BEST = 4
MARK = "▁"
CACHED = 400_000
LONGEST_CACHED = 32
UNKNOWN_COST = 10.0
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")
# A literal mark is a segment of its own; a line break too; else blanks with the word after them.
SEGMENT = re.compile("▁|\n| +[^ \n▁]*|[^ \n▁]+")

Path = tuple[float, tuple[int, ...]]


class Pieces:
    """The pieces and scores of a SentencePiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw: list[bytes] = []
        # Every beginning of a piece, with the ids and score of the piece that it is, if any.
        self.begun: dict[str, tuple[tuple[int], float] | None] = {}
        self.inside: set[str] = set()
        byte_ids: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(BYTE_PIECE.match(piece)[1], 16)
                byte_ids[byte] = i
                self.raw.append(bytes([byte]))
            elif model.is_control(i) or model.is_unknown(i):
                self.raw.append(b"")
            else:
                text = piece.replace(MARK, " ")
                self.raw.append(text.encode())
                for n in range(1, len(text)):
                    self.begun.setdefault(text[:n])
                    self.inside.add(text[n - 1 : n + 1])
                self.begun[text] = ((i,), model.get_score(i))
        self.byte_ids = [byte_ids[b] for b in range(256)]
        # The same as a tree by characters: (what follows, ids, score), without ids where no piece ends.
        self.tree: dict[str, tuple] = {}
        for text, piece in self.begun.items():
            at = self.tree
            for char in text[:-1]:
                at = at[char][0]
            at[text[-1]] = (at[text[-1]][0] if text[-1] in at else {}, *(piece or (None, 0.0)))
        self.unknown = min(p[1] for p in self.begun.values() if p and p[1] > -1e8) - UNKNOWN_COST

    def cuts(self, segment: str) -> list[str]:
        """The parts of a segment between which no piece can reach."""
        inside, at, out = self.inside, 0, []
        for i in range(1, len(segment)):
            if segment[i - 1 : i + 1] not in inside:
                out.append(segment[at:i])
                at = i
        out.append(segment[at:])
        return out

    def edges(self, segment: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end in the segment: (start, ids, score) of the pieces that end there."""
        n = len(segment)
        out: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        begun = self.begun
        for start in range(n):
            single, end = False, start + 1
            while end <= n:
                piece = begun.get(segment[start:end], False)
                if piece:
                    out[end].append((start, *piece))
                    single |= end == start + 1
                elif piece is False:
                    break
                end += 1
            if not single:
                raw = segment[start].encode("utf-8", "surrogatepass")
                out[start + 1].append((start, tuple([self.byte_ids[b] for b in raw]), self.unknown))
        return out

    def two_best(self, segment: str) -> tuple[float, tuple[int, ...], float]:
        """Score and ids of the best segmentation, and what the second one costs over it."""
        n, none, tree = len(segment), float("-inf"), self.tree
        first, second, back = [none] * (n + 1), [none] * (n + 1), [None] * (n + 1)
        first[0] = 0.0
        for start in range(n):
            a, b, single, node, end = first[start], second[start], False, tree, start
            for char in segment[start:]:
                found = node.get(char)
                if found is None:
                    break
                node, ids, score = found
                end += 1
                if ids is None:
                    continue
                x, top = a + score, first[end]
                if x > top:
                    first[end], back[end] = x, (start, ids)
                    x = b + score
                    second[end] = top if top > x else x
                elif x > second[end]:
                    second[end] = x
                if end == start + 1:
                    single = True
            if not single:
                end, x = start + 1, a + self.unknown
                ids = tuple([self.byte_ids[c] for c in segment[start].encode("utf-8", "surrogatepass")])
                if x > first[end]:
                    second[end] = max(first[end], b + self.unknown)
                    first[end], back[end] = x, (start, ids)
                elif x > second[end]:
                    second[end] = x
        at, parts = len(segment), []
        while at:
            at, ids = back[at]
            parts.append(ids)
        return first[-1], tuple([i for ids in reversed(parts) for i in ids]), first[-1] - second[-1]

    def n_best(self, segment: str, n: int) -> list[Path]:
        """The n best segmentations with their scores, best first; equal scores by their ids."""
        if segment == MARK:
            return [(self.unknown, tuple([self.byte_ids[b] for b in MARK.encode()]))]
        into = self.edges(segment)
        best = [0.0] * len(into)
        for end in range(1, len(into)):
            best[end] = max([best[start] + score for start, _, score in into[end]])
        # (-score of the best completion, ids so far from the back, place, score so far)
        queue: list[tuple[float, tuple[int, ...], int, float]] = [(-best[-1], (), len(segment), 0.0)]
        found: list[Path] = []
        while queue:
            cost, ids, at, score = heapq.heappop(queue)
            if len(found) >= n and -cost < found[n - 1][0]:
                break
            if at == 0:
                found.append((score, ids))
                continue
            for start, own, value in into[at]:
                total = score + value
                heapq.heappush(queue, (-(best[start] + total), own + ids, start, total))
        return sorted(found, key=lambda p: (-p[0], p[1]))[:n]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, without the blank that encoding puts in front."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


class Segments(dict):
    """(score, ids, gap) of segments; those used of late are remembered longest."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.pieces, self.old = pieces, {}

    def __missing__(self, segment: str) -> tuple[float, bytes, float]:
        found = self.old.get(segment)
        if found is None:
            found = self._made(segment)
            if len(segment) > LONGEST_CACHED:
                return found
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[segment] = found
        return found

    def _made(self, segment: str) -> tuple[float, bytes, float]:
        if segment == MARK:
            ids = [self.pieces.byte_ids[b] for b in MARK.encode()]
            return self.pieces.unknown, array("I", ids).tobytes(), float("inf")
        parts = self.pieces.cuts(segment)
        if len(parts) > 1:
            own = [self[p] for p in parts]
            return sum([p[0] for p in own]), b"".join([p[1] for p in own]), min([p[2] for p in own])
        score, ids, gap = self.pieces.two_best(segment)
        return score, array("I", ids).tobytes(), gap


class Encoder:
    """Encodes texts to their N best segmentations."""

    def __init__(self, path: str, n: int = N_BEST) -> None:
        if n < 1:
            raise ValueError("one segmentation at least")
        self.pieces, self.n = Pieces(path), n
        self.known = Segments(self.pieces)

    def encode(self, text: str) -> tuple[list[bytes], list[float], list[dict[int, Path]]]:
        """Ids of each segment's best segmentation, scores of the text's N best, and what each of these changes.

        A change names the number of a segment and its own segmentation.
        """
        segments = SEGMENT.findall(" " + text) if text else []
        if not segments:
            return [], [0.0], [{}]
        scores, own, gaps = zip(*map(self.known.__getitem__, segments), strict=True)
        closest = []
        if self.n > 1:
            near = heapq.nsmallest(self.n - 1, gaps)
            closest = heapq.nsmallest(self.n - 1, [(g, i) for i, g in enumerate(gaps) if g <= near[-1]])
            closest = [i for gap, i in closest if gap < float("inf")]
        paths = [self.pieces.n_best(segments[i], self.n) for i in closest]
        total = sum(scores)
        # Hypotheses are (cost over the best, ranks in the closest segments).
        queue: list[tuple[float, tuple[int, ...]]] = [(0.0, (0,) * len(closest))]
        seen, costs, changes = {queue[0][1]}, [], []
        while queue and len(costs) < self.n:
            cost, ranks = heapq.heappop(queue)
            costs.append(cost)
            changes.append({closest[j]: paths[j][r] for j, r in enumerate(ranks) if r})
            for j, path in enumerate(paths):
                after = (*ranks[:j], ranks[j] + 1, *ranks[j + 1 :])
                if after[j] < len(path) and after not in seen:
                    seen.add(after)
                    heapq.heappush(queue, (cost + path[ranks[j]][0] - path[after[j]][0], after))
        return own, [total - c for c in costs], changes

    def all_ids(self, own: list[bytes], changes: list[dict[int, Path]]) -> list[bytes]:
        """Ids of the N best segmentations, from what ``encode`` gave."""
        ids = b"".join(own)
        if len(changes) == 1:
            return [ids]
        starts = [0, *accumulate(map(len, own))]
        out = []
        for change in changes:
            parts, at = [], 0
            for k in sorted(change):
                parts += [ids[at : starts[k]], array("I", change[k][1]).tobytes()]
                at = starts[k + 1]
            out.append(b"".join([*parts, ids[at:]]) if parts else ids)
        return out

    def n_best(self, text: str) -> list[tuple[float, list[int]]]:
        """The N best segmentations of a text in full."""
        own, scores, changes = self.encode(text)
        every = self.all_ids(own, changes)
        return [(score, list(memoryview(ids).cast("I"))) for score, ids in zip(scores, every, strict=True)]


@lru_cache(maxsize=1)
def encoder_of(path: str, n: int) -> Encoder:
    """One encoder for the tasks that a worker process runs one after another, with the segments it remembers."""
    return Encoder(path, n)


def encode_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    model_path: str | None = None,
    n_best: int = N_BEST,
    with_ids: bool = True,
) -> DataFrame:
    """``(doc_id, n_pieces, scores, ids_crc32, decoded, all_pieces, all_crc32[, ids, all_ids])`` of each document.

    ``scores`` are those of the N best segmentations of the whole text, fewer if it has fewer;
    ``ids`` are the best one's, as little-endian unsigned 32-bit numbers, and ``decoded`` says that
    decoding them gave the text.  ``all_pieces``, ``all_crc32`` and ``all_ids`` have number of pieces, digest and
    ids of each of the N, best first.  A null text is an empty one, which has no pieces and one
    segmentation of score 0.  Null ids and repeated rows stay as they are, an empty table
    gives no rows, and other columns are not looked at.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, n_best)
        pieces = encoder.pieces
        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.bool_(), longs, longs, pa.binary(), pa.list_(pa.binary())]
        kinds = kinds[: len(names) - 1]
        for batch in slices(batches):
            rows = []
            for text in texts_of(batch, "text"):
                own, scores, changes = encoder.encode(text)
                every = encoder.all_ids(own, changes)
                ids = every[0]
                sizes, digests = [len(x) // 4 for x in every], [zlib.crc32(x) for x in every]
                same = pieces.decode(memoryview(ids).cast("I")) == text
                rows.append((sizes[0], scores, digests[0], same, sizes, digests, ids, every)[: len(kinds)])
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    names = ["doc_id", "n_pieces", "scores", "ids_crc32", "decoded", "all_pieces", "all_crc32", "ids", "all_ids"]
    names = names[: 9 if with_ids else 7]
    schema = "doc_id long, n_pieces long, scores array<double>, ids_crc32 long, decoded boolean, "
    schema += "all_pieces array<long>, all_crc32 array<long>"
    narrow = docs.selectExpr(f"cast(`{id_column}` as long) as doc_id", f"`{text_column}` as text")
    return narrow.mapInArrow(run, schema + ", ids binary, all_ids array<binary>" * with_ids)


def decode_documents(encoded: DataFrame, *, model_path: str | None = None) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``.

    Null ids of pieces give a null text, empty ones an empty text.  Null document ids and repeated rows stay as they are, an
    empty table gives no rows, and other columns are not looked at.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for batch in slices(batches):
            texts = [
                None if ids is None else pieces.decode(memoryview(ids).cast("I"))
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
