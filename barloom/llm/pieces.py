"""SentencePiece encoding and decoding: the n best segmentations of a text over the lattice of its pieces."""

import hashlib
import heapq
import math
import random
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.units import CACHES

SPACE = "▁"
#: Stands for a SPACE sign that the text itself holds: no text and no piece can have it.
LITERAL = "\ud800"
#: What an unknown character costs beyond the worst piece; pieces below FORBIDDEN are not counted as the worst.
PENALTY, FORBIDDEN = 10.0, -1e8
#: Words whose segmentations a worker keeps at least; at twice as many it begins anew.
KEPT = 300_000
#: Characters of words that are cut together as arrays, and the longest such word; a longer one is cut by itself.
AT_ONCE, LONG = 1 << 17, 64
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Different words that a task counts before it hands them on.
COUNTED = 300_000
#: Log probabilities are multiples of its inverse, so that sums of them are exact in any order.
GRAIN = 1 << 16

#: Stands for text that no piece ends with.
NO_ENDING = object()

Path = tuple[float, tuple[int, ...]]


@dataclass
class Pieces:
    """A vocabulary: pieces with ids and scores, and how to write what it lacks."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_ids: list[int]
    raw: list[bytes]  # by id, what the piece stands for
    unknown: int = 0
    prefix: bool = True
    longest: int = 1
    worst: float = 0.0
    pairs: frozenset = frozenset()
    splits: bool = True
    endings: dict[str, float | None] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.worst = min((s for s in self.scores.values() if s > FORBIDDEN), default=0.0) - PENALTY
        # two neighbouring characters that no piece has next to each other: every segmentation is cut between them
        self.pairs = frozenset(piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1))
        # what pieces end with, and the score where that is a piece itself: nothing else is worth a look
        self.endings = {piece[i:]: None for piece in self.scores for i in range(1, len(piece))} | self.scores
        # a space sign only ever begins pieces (alone or several): words can be segmented one by one
        self.splits = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.pairs)


def load(path: str = MODEL) -> Pieces:
    """The vocabulary of a SentencePiece model file, read on the driver; tasks get it with their code. The scores of a BPE
    model are ranks of merges, which only :func:`merged` can use as they are: for a lattice see :func:`counted`."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, by_byte, raw = {}, {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            by_byte[int(piece[3:-1], 16)] = i
            raw.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            raw.append(piece.replace(SPACE, " ").encode())
    if -1 in by_byte:
        raise ValueError(f"{path} has no pieces for single bytes, so that texts could not be restored")
    return Pieces(ids, scores, by_byte, raw, model.unk_id())


def merged(word: str, pieces: Pieces) -> list[str]:
    """The word as a BPE model cuts it: of all neighbours that make a piece together, those of the highest score are
    merged first, the leftmost of equal ones."""
    parts, scores = list(word), pieces.scores
    size = len(parts)
    if size <= LONG:  # looking through all neighbours is quicker than a heap of them
        get, none = scores.get, -math.inf
        worth = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while worth and (top := max(worth)) > none:
            i = worth.index(top)
            parts[i] += parts.pop(i + 1)
            del worth[i]
            if i < len(worth):
                worth[i] = get(parts[i] + parts[i + 1], none)
            if i:
                worth[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(-scores[two], i, two) for i in range(size - 1) if (two := parts[i] + parts[i + 1]) in scores]
    heapq.heapify(heap)
    while heap:
        _, i, two = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= size or len(parts[i]) + len(parts[j]) != len(two):
            continue  # one of them was merged with another since
        parts[i], parts[j] = two, ""
        after[i] = after[j]
        if after[i] < size:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < size and (more := parts[a] + parts[b]) in scores:
                heapq.heappush(heap, (-scores[more], a, more))
    return [part for part in parts if part]


def counted(docs: DataFrame, pieces: Pieces, text: str = "text") -> Pieces:
    """The vocabulary with log probabilities as scores, for the lattice: how often each piece occurs when all documents
    are cut as the BPE model cuts them (:func:`merged`), half an occurrence added to each. Words are counted in every task
    before the shuffle, different words are cut once; the driver gets a row for each piece of the vocabulary."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, found = Encoder(pieces, 1), Counter()
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                texts = [text or "" for text in whole.column(0).slice(first, 1024).to_pylist()]
                plain, other = encoder.plain(texts)
                if plain:
                    counts = split_at_blanks([texts[i] for i in plain]).values.value_counts()
                    for word, count in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                        found[SPACE + word] += count
                for i in other:
                    found.update(encoder._words(texts[i]) if texts[i] else ())
                if len(found) > COUNTED:
                    yield _counts([w.encode("utf-8", "surrogatepass") for w in found], list(found.values()), pa.binary())
                    found.clear()
        yield _counts([w.encode("utf-8", "surrogatepass") for w in found], list(found.values()), pa.binary())

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in merged(word.decode("utf-8", "surrogatepass"), pieces):
                    number = pieces.ids.get(part)
                    if number is not None:
                        found[number] = found.get(number, 0) + count
        yield _counts(list(found), list(found.values()), pa.int64())

    each = docs.select(text).mapInArrow(words, "key binary, count long").groupBy("key").agg(F.sum("count").alias("count"))
    sums = each.mapInArrow(cuts, "key long, count long").groupBy("key").agg(F.sum("count").alias("count"))
    have = {row["key"]: row["count"] for row in sums.collect()}
    total = sum(have.values()) + 0.5 * len(pieces.ids)
    worth = lambda number: round(math.log((have.get(number, 0) + 0.5) / total) * GRAIN) / GRAIN
    # pieces that may not be used stay so
    scores = {piece: worth(pieces.ids[piece]) if score > FORBIDDEN else score for piece, score in pieces.scores.items()}
    return replace(pieces, scores=scores)


def split_at_blanks(texts: list[str]) -> pa.LargeListArray:
    """The words of texts that are :meth:`Encoder.plain`, without the sign that each begins with."""
    found = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    return found.cast(pa.large_list(pa.large_string()))


def _counts(keys: list, counts: list[int], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(counts, pa.int64())], names=["key", "count"])


def viterbi(text: str, pieces: Pieces) -> tuple[list[float], list[list[tuple[int, float]]]]:
    """Forward: for each place the score of the best way to it from the start, and the pieces that end there as
    (start, score). A character that is no piece by itself is an edge of its own, written as bytes."""
    best, ending, worst = [0.0], [[]], pieces.worst
    get, none = pieces.endings.get, NO_ENDING
    for end in range(1, len(text) + 1):
        start = end - 1
        score = get(text[start:end], none)
        known = score is not none
        found = [(start, worst if not known or score is None else score)]
        while known and start:  # back as far as some piece ends like this
            start -= 1
            score = get(text[start:end], none)
            known = score is not none
            if known and score is not None:
                found.append((start, score))
        found.reverse()
        best.append(max(best[start] + score for start, score in found))
        ending.append(found)
    return best, ending


def n_best(text: str, pieces: Pieces, n: int) -> list[Path]:
    """The n best segmentations as (score, ids), best first: A* from the end of the text backwards. What is left of a
    hypothesis is known exactly from the forward scores, so hypotheses are finished in the order of their whole score;
    equal ones in the order they were found."""
    best, ending = viterbi(text, pieces)
    heap, out, order, taken = [(-best[-1], 0, len(text), 0.0, None)], [], 1, [0] * (len(text) + 1)
    while heap and len(out) < n:
        _, _, place, score, tail = heapq.heappop(heap)
        taken[place] += 1
        if taken[place] > n:  # n better hypotheses went on from here, each with the same ways to the start
            continue
        if not place:
            cut, ids = tail, []
            while cut:
                start, end, cut = cut
                ids += _written(text[start:end], pieces)
            out.append((score, tuple(ids)))
            continue
        for start, worth in ending[place]:
            heapq.heappush(heap, (-(best[start] + worth + score), order, start, score + worth, (start, place, tail)))
            order += 1
    return out


def _written(piece: str, pieces: Pieces) -> list[int]:
    known = pieces.ids.get(piece)
    if known is not None:
        return [known]
    return [pieces.bytes_ids[b] for b in (SPACE if piece == LITERAL else piece).encode()]


def best_of_sorted(words: list[str], pieces: Pieces) -> Iterator[tuple[float, bytes, float]]:
    """For each of the sorted words (score, ids as bytes, what the second best segmentation loses), from the forward
    pass alone, which a word takes over from the one before as far as their common prefix goes; of equal ways to a place
    the one with the longest last piece."""
    low, worst, ids = -float("inf"), pieces.worst, pieces.ids
    get, none = pieces.endings.get, NO_ENDING
    best, second, back, last = [0.0], [low], [0], ""
    for word in words:
        known, size = 0, len(word)
        for x, y in zip(last, word):
            if x != y:
                break
            known += 1
        del best[known + 1 :], second[known + 1 :], back[known + 1 :]
        last = word
        for end in range(known + 1, size + 1):
            # the character alone, which is an edge even if it is no piece; then back as far as some piece ends like this
            start = end - 1
            score = get(word[start:end], none)
            known_end = score is not none
            if not known_end or score is None:
                score = worst
            top, other, cut = best[start] + score, second[start] + score, start
            while known_end and start:
                start -= 1
                score = get(word[start:end], none)
                if score is none:
                    break
                if score is not None:
                    value = best[start] + score
                    if value >= top:
                        top, cut, value = value, start, top
                    if value > other:
                        other = value
                    value = second[start] + score
                    if value > other:
                        other = value
            best.append(top)
            second.append(other)
            back.append(cut)
        out, end = [], size
        while end:
            start = back[end]
            one = ids.get(word[start:end])
            if one is not None:
                out.append(one)
            else:
                out += reversed(_written(word[start:end], pieces))
            end = start
        out.reverse()
        yield best[size], array("i", out).tobytes(), best[size] - second[size]


class Lattice:
    """Pieces as arrays, to cut many words together. What pieces end with is a trie read from the end: the child of a node
    by a character is at the node's place plus the character's number, if the node owns that entry."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        nodes = {"": 0} | {key: i for i, key in enumerate(sorted(pieces.endings, key=len), 1)}
        chars = sorted({key[0] for key in pieces.endings})
        self.numbers = np.zeros(ord(chars[-1]) + 2 if chars else 1, np.int32)  # 0 and the last entry: no piece has it
        self.numbers[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.scores = np.array([math.nan] + [math.nan if (s := pieces.endings[key]) is None else s for key in nodes if key])
        self.ids = np.array([pieces.ids.get(key, -1) for key in nodes], np.int32)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, node in nodes.items():
            if key:
                children.setdefault(nodes[key[1:]], []).append((int(self.numbers[ord(key[0])]), node))
        self.places = np.zeros(len(nodes), np.int32)
        size, pick = 4 * len(nodes), random.Random(1)
        owner, child = [-1] * (size + len(chars) + 1), [0] * (size + len(chars) + 1)
        # nodes with many children first, the root at 0; a place that no other node's entries meet is soon found by chance
        for node, below in sorted(children.items(), key=lambda item: (item[0] > 0, -len(item[1]))):
            for place in (pick.randrange(size) if node else 0 for _ in range(1000)):
                if all(owner[place + number] < 0 for number, _ in below):
                    break
            else:
                place = len(owner)
                owner += [-1] * (len(chars) + 1)
                child += [0] * (len(chars) + 1)
            self.places[node] = place
            for number, to in below:
                owner[place + number], child[place + number] = node, to
        # beyond the last place any character's number is still within the arrays
        self.owner = np.array(owner + [-1] * (len(chars) + 1), np.int32)
        self.child = np.array(child + [0] * (len(chars) + 1), np.int32)

    def cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the score of the best way, what the second best loses, where its ids begin and how many they are;
        and all ids. The same as :func:`best_of_sorted`, for words that are not empty, one place of all words after the other."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int32, n)
        order = np.argsort(-lengths, kind="stable")  # words that are still going on at a place come first
        left, longest = lengths[order], int(lengths.max())
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = (np.cumsum(lengths) - lengths)[order]
        going = np.searchsorted(-left, -np.arange(1, longest + 1), "right")
        column = np.concatenate([[0], np.cumsum(going)])
        points = points[np.concatenate([begin[:k] + i for i, k in enumerate(going.tolist())])]
        codes = self.numbers[np.minimum(points, len(self.numbers) - 1)]
        end = np.repeat(np.arange(1, longest + 1, dtype=np.int32), going)
        row = np.concatenate([np.arange(k, dtype=np.int32) for k in going.tolist()])

        # pieces that end at each place: a character alone is an edge even if it is no piece
        known = self.owner[codes] == 0
        node = np.where(known, self.child[codes], 0)
        single, single_id = self.scores[node], self.ids[node]
        single[np.isnan(single)] = self.pieces.worst
        single_id[~known] = -1
        at = np.flatnonzero(known)
        end, row, node, edges = end[at], row[at], node[at], []
        for size in range(2, self.pieces.longest + 1):
            at = int(np.searchsorted(end, size))
            end, row, node = end[at:], row[at:], node[at:]
            entry = self.places[node] + codes[column[end - size] + row]
            at = np.flatnonzero(self.owner[entry] == node)
            if not len(at):
                break
            end, row, node = end[at], row[at], self.child[entry[at]]
            scores = self.scores[node]
            at = np.flatnonzero(~np.isnan(scores))
            edges.append((np.searchsorted(end[at], np.arange(longest + 2)).tolist(), row[at], scores[at], self.ids[node[at]]))

        best, second, back, ids = [np.zeros(n)], [np.full(n, -np.inf)], [], []
        for place, k in enumerate(going.tolist(), 1):
            own = slice(column[place - 1], column[place])
            top, other = best[-1][:k] + single[own], second[-1][:k] + single[own]
            cut, piece = np.ones(k, np.int32), single_id[own]
            for size, (bounds, rows, scores, numbers) in enumerate(edges[: place - 1], 2):
                a, b = bounds[place], bounds[place + 1]
                if a < b:
                    at, worth = rows[a:b], scores[a:b]
                    value, before = best[place - size][at] + worth, top[at]
                    less = np.maximum(np.minimum(value, before), second[place - size][at] + worth)
                    other[at] = np.maximum(other[at], less)
                    top[at] = np.maximum(value, before)
                    won = value >= before
                    cut[at[won]] = size
                    piece[at[won]] = numbers[a:b][won]
            best.append(top)
            second.append(other)
            back.append(cut)
            ids.append(piece)

        score, loss = np.empty(n), np.empty(n)
        for place, (k, later) in enumerate(zip(going.tolist(), [*going.tolist()[1:], 0]), 1):
            score[later:k] = best[place][later:k]
            loss[later:k] = best[place][later:k] - second[place][later:k]
        back, ids = np.concatenate(back), np.concatenate(ids)
        at, taken = np.arange(n), []
        while len(at):
            flat = column[left - 1] + at
            taken.append((at, flat))
            left = left - back[flat]
            at, left = at[left > 0], left[left > 0]
        sizes = np.bincount(np.concatenate([rows for rows, _ in taken]), minlength=n)
        flat, last = np.empty(int(sizes.sum()), np.int64), np.cumsum(sizes) - 1
        for i, (rows, some) in enumerate(taken):
            flat[last[rows] - i] = some
        ids = ids[flat]
        if (ids < 0).any():
            ids, more = self._with_bytes(ids, points[flat])
            sizes = np.add.reduceat(more, last + 1 - sizes)
        starts = np.cumsum(sizes) - sizes
        back = np.argsort(order)
        return score[back], loss[back], starts[back], sizes[back], ids

    def _with_bytes(self, ids: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids with the bytes of those characters that no piece has, and how many each one became."""
        sizes, missing = np.ones(len(ids), np.int64), np.flatnonzero(ids < 0)
        written = {point: _written(chr(point), self.pieces) for point in np.unique(points[missing]).tolist()}
        lines = [written[point] for point in points[missing].tolist()]
        sizes[missing] = [len(line) for line in lines]
        out = np.repeat(ids, sizes)
        out[np.repeat(ids < 0, sizes)] = [number for line in lines for number in line]
        return out, sizes


class _Numbers(dict):
    """Words by number, in the order in which they were first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Segmentations of texts, with those of recent words kept for the next texts."""

    WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def __init__(self, pieces: Pieces, n: int, kept: int = KEPT):
        self.pieces, self.n, self.kept = pieces, n, kept
        self.lattice: Lattice | None = None
        self._forget()

    def _forget(self) -> None:
        self.known, self.ways = _Numbers(), {}
        self.words: list[str] = []
        # by number: the best way's score, what the second best loses, where the best way's ids begin and how many they are
        self.score, self.loss, self.start, self.size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _words(self, text: str) -> list[str]:
        sign = text.replace(SPACE, LITERAL) if SPACE in text else text
        sign = (SPACE if self.pieces.prefix else "") + sign.replace(" ", SPACE)
        return self.WORD.findall(sign) if self.pieces.splits else [sign]

    def plain(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Places of the texts whose words are what lies between single blanks, and of all others."""
        fine = lambda text: not (not text or text[0] == " " or "  " in text or SPACE in text or LITERAL in text)
        if not (self.pieces.splits and self.pieces.prefix):
            return [], list(range(len(texts)))
        found = [fine(text) for text in texts]
        return [i for i, yes in enumerate(found) if yes], [i for i, yes in enumerate(found) if not yes]

    def _numbered(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of each text's words."""
        number, out = self.known.__getitem__, [np.zeros(0, np.int64)] * len(texts)
        plain, other = self.plain(texts)
        if plain:
            lines = split_at_blanks([texts[i] for i in plain])
            words = lines.values.dictionary_encode()
            numbers = np.array([number(SPACE + word) for word in words.dictionary.to_pylist()], np.int64)
            every, bounds = numbers[words.indices.to_numpy()], lines.offsets.to_pylist()
            for i, a, b in zip(plain, bounds, bounds[1:]):
                out[i] = every[a:b]
        for i in other:
            if texts[i]:
                words = self._words(texts[i])
                out[i] = np.fromiter(map(number, words), np.int64, len(words))
        return out

    def _learn(self) -> None:
        """The best way of all words that were numbered since the last time."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        self.words += new
        if self.lattice is None:
            self.lattice = Lattice(self.pieces)
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        score, loss, start, size = np.empty(len(new)), np.empty(len(new)), np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        ids, past = [self.ids], len(self.ids)
        short = np.flatnonzero(lengths <= LONG)
        parts = np.cumsum(lengths[short]) // AT_ONCE
        for some in np.split(short, np.flatnonzero(np.diff(parts)) + 1) if len(short) else []:
            score[some], loss[some], begin, size[some], found = self.lattice.cut([new[i] for i in some.tolist()])
            start[some] = begin + past
            ids.append(found)
            past += len(found)
        long = sorted(np.flatnonzero(lengths > LONG).tolist(), key=new.__getitem__)
        for i, (worth, line, less) in zip(long, best_of_sorted([new[i] for i in long], self.pieces)):
            score[i], loss[i], start[i], size[i] = worth, less, past, len(line) // 4
            ids.append(np.frombuffer(line, np.int32))
            past += len(line) // 4
        both = lambda *parts: np.concatenate(parts)
        self.score, self.loss = both(self.score, score), both(self.loss, loss)
        self.start, self.size, self.ids = both(self.start, start), both(self.size, size), both(*ids)

    def _ways(self, number: int) -> list[tuple[float, bytes]]:
        """What each further segmentation of the word loses, and its ids."""
        ways = self.ways.get(number)
        if ways is None:
            word, start = self.words[number], self.start[number]
            score, first = float(self.score[number]), self.ids[start : start + self.size[number]].tobytes()
            found = n_best(word, self.pieces, self.n)
            ways = [(score - worth, array("i", ids).tobytes()) for worth, ids in found]
            # of equal ways the forward pass chose one
            ways = self.ways[number] = [way for way in ways if way[1] != first][: self.n - 1]
        return ways

    def encode(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        """The n best (score, ids as int32 bytes) of each whole text."""
        if len(self.known) > 2 * self.kept:
            self._forget()
        numbers = self._numbered(texts)
        self._learn()
        return [self._encode(at) for at in numbers]

    def _encode(self, at: np.ndarray) -> list[tuple[float, bytes]]:
        if not len(at):
            return [(0.0, b"")]
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        first = self.ids[np.repeat(self.start[at] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()
        score = sum(self.score[at].tolist())
        # among the n best, only the n - 1 words that lose least by their second way can differ from the first
        losses, changes = self.loss[at], [(0.0, ())]
        for _ in range(self.n - 1):
            i = int(losses.argmin())
            if losses[i] == np.inf:
                break
            losses[i] = np.inf
            more = [(a + b, (*picked, (i, other))) for a, picked in changes for b, other in self._ways(int(at[i]))]
            changes = sorted(changes + more, key=lambda way: way[0])[: self.n]
        ways = [(score, first)]
        for loss, picked in changes[1:]:
            other, past = [], 0
            for i, way in sorted(picked):
                other += [first[past : 4 * int(ends[i] - sizes[i])], way]
                past = 4 * int(ends[i])
            ways.append((score - loss, b"".join([*other, first[past:]])))
        return ways


def decode(ids, pieces: Pieces) -> str:
    """The text of a segmentation."""
    raw = b"".join(map(pieces.raw.__getitem__, ids))
    return raw.decode("utf-8", "replace")[1 if pieces.prefix and raw[:1] == b" " else 0 :]


_encoders: dict[str, Encoder] = {}
CACHES.append(_encoders)


def _encoder(name: str, pieces: Pieces, n: int, kept: int) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(pieces, n, kept)
    return _encoders[name]


_WAY = "array<struct<score:double,ids:array<int>>>"


def encode(
    docs: DataFrame, pieces: Pieces, n: int = 4, text: str = "text", columns: tuple[str, str] = ("n_best", "restored"),
    kept_words: int = KEPT, rows: int = 1024,
) -> DataFrame:
    """``docs`` with the ``n`` best segmentations of each whole text, best first, as (score, ids), and the text that the
    best one decodes to (columns of these names are replaced). The score is the sum of the pieces' scores.

    The lattice of a text falls apart where no piece crosses: between words, and between characters that no piece has
    next to each other. Each stretch is searched by itself and kept for the next text; the n best of the whole text are
    exact sums of those. One pass without a shuffle. An empty text has one segmentation, without pieces; a null text has
    none, and null is restored. Repeated rows are encoded alike. Characters that no piece has become bytes, so every text is
    restored exactly. A text with few ways has fewer than n. ``kept_words`` and ``rows`` (texts handled at once) trade a
    worker's memory for time; the result does not depend on them.
    """
    kept = [c for c in docs.columns if c not in columns]
    docs = docs.select(*kept)
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(f"`{columns[0]}` {_WAY}, `{columns[1]}` string").fields)
    add = _adding(pieces, n, kept, kept.index(text), columns, kept_words, rows)
    return docs.mapInArrow(add, schema)


def _adding(pieces: Pieces, n: int, kept: list[str], at: int, columns: tuple[str, str], kept_words: int, rows: int):
    name = f"{_name(pieces, n)}-{kept_words}"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, pieces, n, kept_words)
        for whole in batches:
            for first in range(0, whole.num_rows, rows):
                batch = whole.slice(first, rows)
                texts = batch.column(at).to_pylist()
                ways = encoder.encode([t or "" for t in texts])
                ways = [None if t is None else w for t, w in zip(texts, ways)]
                back = [None if w is None else decode(np.frombuffer(w[0][1], np.int32).tolist(), pieces) for w in ways]
                flat = [way for w in ways if w for way in w]
                sizes = np.array([len(ids) // 4 for _, ids in flat], np.int64)
                numbers = pa.array(np.frombuffer(b"".join(ids for _, ids in flat), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), numbers)
                each = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.float64()), ids], ["score", "ids"])
                counts = np.concatenate([[0], np.cumsum([len(w or ()) for w in ways])])
                places = pa.array([None if w is None else c for w, c in zip(ways, counts.tolist())] + [int(counts[-1])], pa.int32())
                found = pa.ListArray.from_arrays(places, each)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, found, pa.array(back, pa.string())], names=[*kept, *columns]
                )

    return add


def _name(pieces: Pieces, n: int) -> str:
    return hashlib.sha256(repr((sorted(pieces.ids.items()), sorted(pieces.scores.items()), n)).encode()).hexdigest()
