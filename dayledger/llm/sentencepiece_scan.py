"""SentencePiece encoding and decoding by a max-plus scan over text chunks.

The model merges the adjacent symbols whose joint piece scores best until none is
left. A sequence of pieces is that result if and only if each piece, and each two
neighbours, come back unchanged when merged alone. So an encoding is the one path
of weight 0 through a lattice whose edges, from piece to next piece, weigh 0 if the
two are stable and minus infinity if not, and max-plus algebra finds it.

A giant text is split into chunks wherever that falls. A state at a cut is a piece
that covers the character before it. Each chunk yields the transfer matrix between
the states of its two cuts, knowing nothing of the others; matrices are combined
associatively, and once the state at every cut is known each chunk traces its own
pieces. Matrices hold only the entries that are 0.

Where no piece of the vocabulary holds two characters in a row, pieces always end
between them: the lattice falls apart into words, which a worker remembers.
"""

from __future__ import annotations

import re
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import text_of, tidy

SPACE = "▁"
#: Characters of a chunk; longer texts are giant.
CHUNK = 1 << 15
#: Words, pieces of words and pairs of pieces that a worker remembers.
REMEMBERED = 400_000
#: Slots of pairs of pieces that are looked up together, as a power of two.
PAIR_BITS = 20
#: Spreads numbers over slots.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Ids that become bytes in one step.
GATHERED = 1 << 16
NEVER = float("-inf")

#: A state: characters from the cut back to the start of its piece, and on to its end.
State = tuple[int, int]
#: The in-states and out-states between which the weight is 0.
Matrix = dict[State, set[State]]
START: State = (0, 0)


def _characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _joined_keys(characters: np.ndarray) -> np.ndarray:
    """Each two characters in a row as one number."""
    return characters[:-1].astype(np.int64) << 32 | characters[1:]


def _slots(values: np.ndarray, bits: int) -> np.ndarray:
    """A number of so many bits for each value."""
    return (values.astype(np.uint64) * SPREAD >> np.uint64(64 - bits)).astype(np.int64)


class Ranks:
    """Distinct numbers in order. Most are found by a slot of their own; the order tells
    where those stand that share one."""

    def __init__(self, values: np.ndarray):
        self.values = np.sort(values)
        self.bits = max(8, len(values).bit_length() + 3)
        slot = _slots(self.values, self.bits)
        self.at = np.full(1 << self.bits, -1, np.int64)
        self.at[slot] = np.arange(len(values))
        self.at[np.bincount(slot, minlength=1 << self.bits) > 1] = -2

    def __len__(self) -> int:
        return len(self.values)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where some values stand, and whether they do."""
        if not len(self.values):
            return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
        at = self.at[_slots(values, self.bits)]
        shared = np.flatnonzero(at == -2)
        at[shared] = np.searchsorted(self.values, values[shared])
        np.clip(at, 0, len(self.values) - 1, out=at)
        return at, self.values[at] == values


class Trie:
    """The pieces as a trie that many positions of a text walk together. A node is its
    rank among those of its depth, by the node before and the character after that."""

    def __init__(self, ids: dict[str, int]):
        single = {p for p in ids if len(p) == 1}
        pieces = [p for p in ids if single.issuperset(p)]  # the others need a letter that has no code
        self.letters = Ranks(_characters("".join(single)))
        self.sizes = np.zeros(max(ids.values(), default=0) + 1, np.int64)
        number = np.array([ids[p] for p in pieces], np.int64)
        self.sizes[number] = [len(p) for p in pieces]
        starts = np.cumsum(self.sizes[number]) - self.sizes[number]
        code = self.codes(_characters("".join(pieces)))
        self.levels: list[tuple[Ranks, np.ndarray]] = []
        node, depth = np.zeros(len(pieces), np.int64), 0
        while len(number):
            keys, node = np.unique(node * len(self.letters) + code[starts + depth], return_inverse=True)
            depth += 1
            piece, ending = np.full(len(keys), -1, np.int64), self.sizes[number] == depth
            piece[node[ending]] = number[ending]
            self.levels.append((Ranks(keys), piece))
            number, node, starts = number[~ending], node[~ending], starts[~ending]
        self.known_alone = np.full(len(self.sizes), -1, np.int8)  # 1 if so, 0 if not

    def codes(self, characters: np.ndarray) -> np.ndarray:
        """The rank of each character among those that are pieces, or -1."""
        at, there = self.letters.find(characters)
        return np.where(there, at, -1)

    def walk(self, code: np.ndarray, left: np.ndarray):
        """For each size: where pieces of it start, and which. ``left`` says how many
        characters from each on are in its part."""
        start, node = np.arange(len(code)), np.zeros(len(code), np.int64)
        for n, (keys, piece) in enumerate(self.levels):
            inside = left[start] > n
            start, node = start[inside], node[inside]
            node, there = keys.find(node * len(self.letters) + code[start + n])
            start, node = start[there], node[there]
            own = piece[node]
            yield start[own >= 0], own[own >= 0]

    def alone(self, lattice: Lattice, pieces: np.ndarray) -> np.ndarray:
        """Which pieces stay whole where nothing is beside them."""
        known = self.known_alone
        for i in np.unique(pieces[known[pieces] < 0]).tolist():
            known[i] = lattice.profile(lattice.pieces[i]) is not None
        return known[pieces] > 0


class Lattice:
    """Pieces of a merging model with byte fallback, and which of them are stable."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [
            not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
            for i in range(size)
        ]
        self.ids = {p: i for i, p in enumerate(self.pieces) if plain[i]}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        self.longest = max(map(len, self.ids))
        #: Two characters in a row of any piece.
        self.joins = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.by_space = not any(x[0] != SPACE and x[1] == SPACE for x in self.joins)
        self.join_keys = Ranks(_joined_keys(_characters("".join(self.joins)))[::2])
        self.trie = Trie(self.ids)
        self.number_pairs: dict[int, bool] = {}
        #: Some of them by slot: the number, and whether they stay apart as its last bit.
        self.pair_slots = np.full(1 << PAIR_BITS, -1, np.int64)
        self.profiles: dict[str, tuple | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.known_parts: dict[str, bytes] = {}
        #: The last piece of the encoding of a text, by text.
        self.last: dict[str, str] = {}

    # --- which pieces are stable ---

    def profile(self, piece: str) -> tuple | None:
        """While a piece is merged from its characters: its last symbol and the score
        of the next merge, and the same for its first symbol. None if not stable."""
        found = self.profiles.get(piece, 0)
        if found == 0:
            symbols, right, left = list(piece), [], []
            while True:
                best, at = NEVER, -1
                for i in range(len(symbols) - 1):
                    score = self.scores.get(symbols[i] + symbols[i + 1], NEVER)
                    if score > best:
                        best, at = score, i
                right.append((symbols[-1], best))
                left.append((symbols[0], best))
                if at < 0:
                    break
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            found = self.profiles[piece] = (right, left) if len(symbols) == 1 else None
        return found

    def stable(self, a: str, b: str) -> bool:
        """Whether two neighbours stay apart: no merge across comes before theirs."""
        known = self.pairs.get((a, b))
        if known is None:
            known = self.pairs[a, b] = self._apart(a, b)
        return known

    def _apart(self, a: str, b: str) -> bool:
        one, two = self.profile(a), self.profile(b)
        if one is None or two is None:
            return False
        right, left, i, j = one[0], two[1], 0, 0
        while True:
            (x, next_a), (y, next_b) = right[i], left[j]
            across = self.scores.get(x + y, NEVER)
            if across > next_a and across >= next_b and across > NEVER:
                return False
            if next_a == NEVER and next_b == NEVER:
                return True
            if next_a >= next_b:
                i += 1
            else:
                j += 1

    # --- the lattice of a stretch of text ---

    def forward(self, text: str, first: int, last: int, entries: dict[int, list[tuple[str, int]]]):
        """Pieces that end at each position and the entries, a bit each, from which
        paths of weight 0 lead to them. ``entries``: position -> (piece, bit) that a
        path may begin with; the empty piece is the beginning of the text. Pieces
        start between ``first`` and ``last`` and may end beyond ``last``."""
        ends: list[dict[str, int]] = [{} for _ in range(min(len(text), last + self.longest) + 1)]
        for position, own in entries.items():
            for piece, bit in own:
                ends[position][piece] = ends[position].get(piece, 0) | bit
        ids, stable = self.ids, self.stable
        for start in range(first, last):
            before = ends[start]
            if not before:
                continue
            for n in range(1, min(self.longest, len(text) - start) + 1):
                piece = text[start : start + n]
                if n > 1:
                    if text[start + n - 2 : start + n] not in self.joins:
                        break
                    if piece not in ids:
                        continue
                bits = 0
                for left, own in before.items():
                    if (stable(left, piece) if left else self.profile(piece) is not None):
                        bits |= own
                if bits:
                    at = ends[start + n]
                    at[piece] = at.get(piece, 0) | bits
        return ends

    def trace(self, text: str, ends: list[dict[str, int]], end: int, piece: str, bit: int, stop: int) -> list[str]:
        """The pieces of the path to ``piece`` at ``end`` that start from ``stop`` on."""
        path = [piece]
        start = end - len(piece)
        while start > stop:
            piece = next(p for p, own in ends[start].items() if own & bit and p and self.stable(p, path[-1]))
            path.append(piece)
            start -= len(piece)
        return path[::-1]

    def cuts(self, text: str) -> list[int]:
        """Positions between characters that no piece holds in a row."""
        keys = _joined_keys(_characters(text))
        return (np.flatnonzero(~self.join_keys.find(keys)[1]) + 1).tolist()

    def parts(self, word: str) -> list[str]:
        at = self.cuts(word)
        if not at:
            return [word]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)]

    def pieces_of(self, part: str) -> list[str]:
        """The path through the lattice of a text that stands alone. At each position
        just one piece ends a path of weight 0; it depends on the text before alone,
        so texts that begin alike share it."""
        size, longest, ids, known, last = len(part), self.longest, self.ids, self.pairs.get, self.last
        done = size
        while done and part[:done] not in last:
            done -= 1
        for end in range(done + 1, size + 1):
            for start in range(max(0, end - longest), end):
                piece = part[start:end]
                if piece in ids or end - start == 1:
                    if start:
                        before = last[part[:start]]
                        stable = known((before, piece))
                        if stable is None:
                            stable = self.stable(before, piece)
                    else:
                        stable = self.profile(piece) is not None
                    if stable:
                        last[part[:end]] = piece
                        break
        path, end = [], size
        while end:
            path.append(last[part[:end]])
            end -= len(path[-1])
        return path[::-1]

    def learn_parts(self, parts: list[str]) -> None:
        """Remember the ids of distinct texts that stand alone: ``pieces_of`` for all of
        them together, by the end of a piece and then from long pieces to short ones."""
        trie = self.trie
        code = trie.codes(_characters("".join(parts)))
        sizes = np.array([len(p) for p in parts], np.int64)
        starts = np.cumsum(sizes) - sizes
        plain = np.minimum.reduceat(code, starts) >= 0 if len(parts) else np.zeros(0, bool)
        for i in np.flatnonzero(~plain).tolist():
            self.part(parts[i])
        code, parts, sizes = code[np.repeat(plain, sizes)], [parts[i] for i in np.flatnonzero(plain).tolist()], sizes[plain]
        begins = np.cumsum(sizes) - sizes
        offset = np.arange(len(code)) - np.repeat(begins, sizes)
        found = trie.walk(code, np.repeat(sizes, sizes) - offset)
        by_end = []
        for n, (start, piece) in enumerate(found, 1):
            end = offset[start] + n
            order = np.argsort(end, kind="stable")
            by_end.append((start[order], piece[order], np.searchsorted(end[order], np.arange(int(sizes.max(initial=0)) + 2))))
        last = np.full(len(code), -1, np.int64)
        for end in range(1, int(sizes.max(initial=0)) + 1):
            for n in range(min(end, len(by_end)), 0, -1):
                start, piece, bounds = by_end[n - 1]
                own = slice(bounds[end], bounds[end + 1])
                start, piece = start[own], piece[own]
                free = last[start + n - 1] < 0
                start, piece = start[free], piece[free]
                if not len(start):
                    continue
                if n == end:
                    stable = trie.alone(self, piece)
                else:
                    stable = self._stable_numbers(last[start - 1] * len(self.pieces) + piece)
                last[start[stable] + n - 1] = piece[stable]
        owner, at, steps = np.arange(len(parts)), begins + sizes, []
        while len(owner):
            piece = last[at - 1]
            steps.append((owner, piece))
            at = at - trie.sizes[piece]
            more = at > begins[owner]
            owner, at = owner[more], at[more]
        owner, piece = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True)) if steps else (np.zeros(0, int),) * 2
        data = piece[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(parts)))).tolist()
        self.known_parts.update(zip(parts, (data[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def _stable_numbers(self, keys: np.ndarray) -> np.ndarray:
        """Which pairs of pieces stay apart, each as one number."""
        slot = _slots(keys, PAIR_BITS)
        found = self.pair_slots[slot]
        missing = np.flatnonzero(found >> 1 != keys)
        if len(missing):
            distinct, place = np.unique(keys[missing], return_inverse=True)
            known, pieces, own = self.number_pairs, self.pieces, []
            for key in distinct.tolist():
                apart = known.get(key)
                if apart is None:
                    a, b = divmod(key, len(pieces))
                    apart = known[key] = self._apart(pieces[a], pieces[b])
                own.append(2 * key + apart)
            own = np.array(own, np.int64)
            self.pair_slots[_slots(distinct, PAIR_BITS)] = own
            found[missing] = own[place]
        return (found & 1).astype(bool)

    def learn_words(self, words: list[str]) -> None:
        """Remember the ids of words, all that are new in some texts."""
        text = "".join(words).replace(" ", SPACE)
        ends = np.cumsum([len(w) for w in words])
        keys = _joined_keys(_characters(text))
        cut = ~self.join_keys.find(keys)[1]
        cut[ends[:-1] - 1] = True
        bounds = [0, *(np.flatnonzero(cut) + 1).tolist(), len(text)]
        parts = [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        self.learn_parts(list(set(parts).difference(self.known_parts)))
        found = list(map(self.known_parts.__getitem__, parts))
        sizes, data = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))), b"".join(found)
        cuts = [0, *sizes[np.searchsorted(bounds[1:], ends)].tolist()]
        self.words.update(zip(words, (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True))

    def numbers(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            own = self.ids.get(p)
            if own is None:
                out.extend(self.bytes[b] for b in p.encode())
            else:
                out.append(own)
        return out

    def word(self, word: str) -> bytes:
        """The ids of a word, as little-endian 32-bit numbers."""
        return b"".join(map(self.part, self.parts(word.replace(" ", SPACE))))

    def part(self, part: str) -> bytes:
        ids = self.known_parts.get(part)
        if ids is None:
            ids = self.known_parts[part] = self._packed(self.pieces_of(part))
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts; what is new in them is worked on together."""
        if not self.by_space:
            return [self.word(" " + t) if t else b"" for t in texts]
        words = [WORD.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        new = set().union(*words).difference(self.words)
        if new:
            self.learn_words(list(new))
        get = self.words.__getitem__
        ids = [b"".join(map(get, own)) for own in words]
        self.forget()
        return ids

    def forget(self) -> None:
        for memory in (self.words, self.known_parts, self.pairs, self.number_pairs, self.last):
            if len(memory) > REMEMBERED:
                memory.clear()

    def release(self) -> None:
        """Forget all at the end of a task, the model too: idle workers keep what they
        remember, and a model is read again in a fraction of a second."""
        for memory in (self.words, self.known_parts, self.pairs, self.number_pairs, self.last, self.profiles):
            memory.clear()
        _lattices.clear()
        _pieces.clear()

    # --- chunks of a giant text ---

    def states(self, text: str, cut: int) -> list[State]:
        """All pieces that cover the character before a cut of a stretch of text."""
        found = []
        for start in range(max(0, cut - self.longest), cut):
            for end in range(cut, min(len(text), start + self.longest) + 1):
                piece = text[start:end]
                if (piece in self.ids or len(piece) == 1) and self.profile(piece) is not None:
                    found.append((cut - start, end - cut))
        return found

    def matrix(self, text: str, first: int, last: int) -> Matrix:
        """The transfer matrix of the chunk ``first``..``last`` of a stretch of text;
        a stretch that begins with its chunk is the beginning of the whole text."""
        entry = self.states(text, first) if first else [START]
        hard = self.hard_cuts(text, first, last)
        out: Matrix = {}
        if hard:
            # from the first such place on, nothing depends on the state any more
            bits = self._ends(text, first, hard[0], entry)[hard[0]] if first else {"": 1}
            into = 0
            for own in bits.values():
                into |= own
            leaving = self._leaving(text, self.forward(text, hard[-1], last, {hard[-1]: [("", 1)]}), last)
            for k, state in enumerate(entry):
                if into >> k & 1:
                    out[state] = set(leaving)
            return out
        for state, own in self._leaving(text, self._ends(text, first, last, entry), last).items():
            for k, before in enumerate(entry):
                if own >> k & 1:
                    out.setdefault(before, set()).add(state)
        return out

    def hard_cuts(self, text: str, first: int, last: int) -> list[int]:
        """Positions from ``first`` to before ``last`` that no piece reaches across."""
        if not first:
            return [0, *self.cuts(text[:last])]
        return [first - 1 + c for c in self.cuts(text[first - 1 : last])]

    def _ends(self, text: str, first: int, last: int, entry: list[State]):
        entries: dict[int, list[tuple[str, int]]] = {}
        for k, (back, on) in enumerate(entry):
            entries.setdefault(first + on, []).append((text[first - back : first + on], 1 << k))
        return self.forward(text, first, last, entries)

    def _leaving(self, text: str, ends: list[dict[str, int]], cut: int) -> dict[State, int]:
        found = {}
        for end in range(cut, len(ends)):
            for piece, own in ends[end].items():
                if piece and end - len(piece) < cut:
                    found[len(piece) - (end - cut), end - cut] = own
        return found

    def chunk(self, text: str, first: int, last: int, entry: State, leave: State) -> bytes:
        """The ids of the pieces after the entry's up to the leaving one."""
        begin, end, out = first + entry[1], last + leave[1], []
        hard = self.hard_cuts(text, first, last)
        if hard:
            if begin < hard[0]:
                ends = self._ends(text, first, hard[0], [entry])
                whole = next(iter(p for p, own in ends[hard[0]].items() if own))
                out.append(self._packed(self.trace(text, ends, hard[0], whole, 1, begin)))
            parts = [text[a:b] for a, b in zip(hard[:-1], hard[1:], strict=True)]
            self.learn_parts(list(set(parts).difference(self.known_parts)))
            out += map(self.known_parts.__getitem__, parts)
            begin = hard[-1]
            ends = self.forward(text, begin, last, {begin: [("", 1)]})
        else:
            ends = self._ends(text, first, last, [entry])
        if end > begin:  # else the piece of the entry reaches as far
            out.append(self._packed(self.trace(text, ends, end, text[last - leave[0] : end], 1, begin)))
        return b"".join(out)

    def _packed(self, pieces: list[str]) -> bytes:
        ids = self.numbers(pieces)
        return pack(f"<{len(ids)}i", *ids)


def raw_pieces(proto: bytes) -> list[bytes]:
    """What each id of a model stands for."""
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(SPACE, " ").encode())
    return out


WORD = re.compile(" *[^ ]+| +")


def combine(one: Matrix, two: Matrix) -> Matrix:
    """The max-plus product of two sparse matrices."""
    out: Matrix = {}
    for state, between in one.items():
        found = set().union(*(two[m] for m in between if m in two))
        if found:
            out[state] = found
    return out


def prefixes(matrices: list[Matrix]) -> list[Matrix]:
    """All products of leading matrices, by halves: products of pairs, their
    prefixes, and from these the ones in between."""
    if len(matrices) < 2:
        return list(matrices)
    paired = [combine(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)]
    even = prefixes(paired)
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(even[i // 2] if i % 2 else combine(even[i // 2 - 1], matrices[i]))
    return out


def path_states(matrices: list[Matrix]) -> list[State]:
    """The state at each cut, the beginning and the end included, on the one path
    from the beginning to a piece that ends with the text."""
    reached = [{START}] + [m.get(START, set()) for m in prefixes(matrices)]
    found = [next(s for s in reached[-1] if s[1] == 0)]
    for k in range(len(matrices) - 1, -1, -1):
        found.append(next(s for s in reached[k] if found[-1] in matrices[k].get(s, ())))
    return found[::-1]


# --- on Spark -----------------------------------------------------------------

_lattices: dict[int, Lattice] = {}


def _lattice(shared) -> Lattice:
    """One lattice for each worker process and model."""
    key = hash(shared.value)
    if key not in _lattices:
        _lattices.clear()
        _lattices[key] = Lattice(shared.value)
    return _lattices[key]


def slices(batches, rows: int = 200):
    """Batches of fewer rows: their values become Python objects, some at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))


_STATE = pa.struct([("back", pa.int32()), ("on", pa.int32())])
_ENTRIES = "array<struct<a:int,b:int,c:int,d:int>>"


def encode(docs: DataFrame, model_file: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with a column ``ids``, an array of int, in place of any of that name.

    The ids are those of the sentencepiece library for models that merge, with byte
    fallback, a leading space and no further normalisation. Null and empty texts
    give no ids. Texts of more than ``chunk`` characters pass as chunks, equal ones
    once. Repeated rows stay; an empty table gives no rows; other columns stay.
    The model file is read on the driver and broadcast: some 0.5 MB.
    """
    spark = docs.sparkSession
    docs = docs.drop("ids")
    with open(model_file, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    size = F.char_length(text_of(text))
    whole = docs.where(size <= chunk).withColumn("ids", F.lit(None).cast("array<int>"))

    def encode_whole(batches):
        lattice = _lattice(shared)
        for batch in slices(batches):
            own = batch.column(batch.schema.names.index(text)).to_pylist()
            at = batch.schema.names.index("ids")
            ids = _lists(lattice.encode_all([t or "" for t in own]))
            yield batch.set_column(at, batch.schema.field(at), ids.cast(batch.schema.field(at).type))
        lattice.release()

    giants = _giants(docs.where(size > chunk), shared, text, chunk)
    return whole.mapInArrow(tidy(encode_whole), whole.schema).unionByName(giants)


def _giants(docs: DataFrame, shared, text: str, chunk: int) -> DataFrame:
    """``docs``, all of giant texts, with their ``ids``; equal texts are worked on once."""
    name = "giant_text_key"
    while name in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, F.sha2(F.col(text).cast("binary"), 256))
    texts = keyed.select(F.col(name).alias("key"), F.col(text).alias("text")).dropDuplicates(["key"])
    ids = _encode_giant(texts, shared, chunk)
    return keyed.join(ids.withColumnRenamed("key", name), name).select(*docs.columns, "ids")


def _encode_giant(texts: DataFrame, shared, chunk: int) -> DataFrame:
    """``key``, ``ids`` of texts (key, text) that are worked on chunk by chunk."""

    def split(batches):
        reach = _lattice(shared).longest
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                line = SPACE + text.replace(" ", SPACE)
                rows = []
                for k, low in enumerate(range(0, len(line), chunk)):
                    begin, high = max(0, low - reach), min(len(line), low + chunk)
                    rows.append((key, k, line[begin : high + reach], low - begin, high - begin))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("key", "k", "stretch", "low", "high"), r, strict=True)) for r in rows],
                    schema=pa.schema(
                        [
                            ("key", pa.string()),
                            ("k", pa.int32()),
                            ("stretch", pa.string()),
                            ("low", pa.int32()),
                            ("high", pa.int32()),
                        ]
                    ),
                )

    def matrices(batches):
        lattice = _lattice(shared)
        for batch in batches:
            rows = batch.to_pydict()
            found = [
                [{"a": a, "b": b, "c": c, "d": d} for (a, b), out in m.items() for c, d in sorted(out)]
                for m in map(lattice.matrix, rows["stretch"], rows["low"], rows["high"])
            ]
            lattice.forget()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(found, pa.list_(pa.struct([(n, pa.int32()) for n in "abcd"]))),
                ],
                names=["key", "k", "entries"],
            )
        lattice.release()

    def scan(key, rows):
        own = sorted(zip(rows.column("k").to_pylist(), rows.column("entries").to_pylist(), strict=True))
        chain: list[Matrix] = []
        for _, entries in own:
            m: Matrix = {}
            for e in entries:
                m.setdefault((e["a"], e["b"]), set()).add((e["c"], e["d"]))
            chain.append(m)
        states = path_states(chain)
        return pa.table(
            {
                "key": pa.array([key[0].as_py()] * len(own), pa.string()),
                "k": pa.array([k for k, _ in own], pa.int32()),
                **{
                    n: pa.array([s[i] for s in at], pa.int32())
                    for n, at, i in (("a", states[:-1], 0), ("b", states[:-1], 1), ("c", states[1:], 0), ("d", states[1:], 1))
                },
            }
        )

    def trace(batches):
        lattice = _lattice(shared)
        for batch in batches:
            r = batch.to_pydict()
            found = [
                lattice.chunk(r["stretch"][i], r["low"][i], r["high"][i], (r["a"][i], r["b"][i]), (r["c"][i], r["d"][i]))
                for i in range(batch.num_rows)
            ]
            lattice.forget()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["key", "k", "part"]
            )
        lattice.release()

    def gather(key, rows):
        order = np.argsort(rows.column("k").to_numpy())
        parts = rows.column("part").to_pylist()
        return pa.table({"key": [key[0].as_py()], "ids": _lists([b"".join(parts[i] for i in order)])})

    chunks = texts.mapInArrow(split, "key string, k int, stretch string, low int, high int").repartition("key", "k")
    states = (
        chunks.mapInArrow(tidy(matrices), f"key string, k int, entries {_ENTRIES}")
        .groupBy("key")
        .applyInArrow(scan, "key string, k int, a int, b int, c int, d int")
    )
    return (
        chunks.join(states, ["key", "k"])
        .mapInArrow(tidy(trace), "key string, k int, part binary")
        .groupBy("key")
        .applyInArrow(gather, "key string, ids array<int>")
    )


class Pieces:
    """The bytes of all pieces one after the other, so that ids become bytes by
    gathering."""

    def __init__(self, proto: bytes):
        raw = raw_pieces(proto)
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.array([len(p) for p in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of texts of so many ids each; the first space is the model's. Ids
        are gathered a stretch at a time, as an index takes eight bytes a byte."""
        sizes = self.sizes[ids]
        ends, parts = np.cumsum(sizes), []
        for low in range(0, len(ids), GATHERED):
            own = sizes[low : low + GATHERED]
            after = np.cumsum(own)
            at = np.repeat(self.starts[ids[low : low + GATHERED]] - (after - own), own)
            at += np.arange(len(at))
            parts.append(self.data[at].tobytes())
        data = b"".join(parts)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        texts = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        return [t[1:] if t[:1] == b" " else t for t in texts]


_pieces: dict[int, Pieces] = {}


def _piece_bytes(shared) -> Pieces:
    key = hash(shared.value)
    if key not in _pieces:
        _pieces.clear()
        _pieces[key] = Pieces(shared.value)
    return _pieces[key]


def _flat(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some lists, and how many each has; null lists have none."""
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    counts = np.diff(ids.offsets.to_numpy())
    if ids.null_count:
        counts = np.where(ids.is_valid().to_numpy(zero_copy_only=False), counts, 0)
    return ids.flatten().to_numpy(zero_copy_only=False), counts


def decode(encoded: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``, the text of its ids; null for null. Bytes
    that are no UTF-8 become U+FFFD."""
    with open(model_file, "rb") as file:
        shared = encoded.sparkSession.sparkContext.broadcast(file.read())
    out = encoded.withColumn("decoded", F.lit(None).cast("string"))

    def run(batches):
        pieces = _piece_bytes(shared)
        for batch in slices(batches):
            own = batch.column(batch.schema.names.index(ids))
            texts = [t.decode("utf-8", "replace") for t in pieces(*_flat(own))]
            found = [t if there else None for t, there in zip(texts, own.is_valid().to_pylist(), strict=True)]
            at = batch.schema.names.index("decoded")
            yield batch.set_column(at, batch.schema.field(at), pa.array(found, pa.string()))

    return out.mapInArrow(tidy(run), out.schema)


def round_trips(docs: DataFrame, model_file: str, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` without its texts, but with ``ids`` and ``round_trip``: whether they
    decode to the text. The character that stands for a space in pieces counts as a
    space. Texts that are not giant are encoded and decoded by one task; those of
    giants do not travel with their ids, but a 64-bit hash does."""
    with open(model_file, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    docs = docs.drop("ids", "round_trip")
    rest = [c for c in docs.columns if c != text]
    size = F.char_length(text_of(text))
    body = F.translate(text_of(text), SPACE, " ").alias("body")
    small = docs.where(size <= chunk).select(F.struct(*(rest or [F.lit(True).alias("none")])).alias("rest"), body)
    kind = dict(small.dtypes)["rest"]

    def run(batches):
        lattice, pieces = _lattice(shared), _piece_bytes(shared)
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            ids = _lists(lattice.encode_all(texts))
            same = [a == b.encode() for a, b in zip(pieces(*_flat(ids)), texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids.cast(pa.list_(pa.int32())), pa.array(same, pa.bool_())], names=["rest", "ids", "round_trip"]
            )
        lattice.release()

    done = small.mapInArrow(tidy(run), f"rest {kind}, ids array<int>, round_trip boolean")
    hashed = docs.where(size > chunk).withColumn("text_hash", F.xxhash64(body))
    giants = decode(_giants(hashed, shared, text, chunk).drop(text), model_file)
    same = F.xxhash64("decoded") == F.col("text_hash")
    return done.select(*(F.col(f"rest.`{c}`").alias(c) for c in rest), "ids", "round_trip").unionByName(
        giants.select(*(F.col(f"`{c}`") for c in rest), "ids", same.alias("round_trip"))
    )
