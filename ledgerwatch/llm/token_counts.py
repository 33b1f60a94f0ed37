"""Token counts by finite-state transducers.

The tokenizer file is compiled into two deterministic transducers.

The first reads classes of characters and emits a mark where a pretoken starts. A text buffer is cut into chunks of equal
length; all chunks run side by side from every entry state, which gives each chunk a map from entry to exit state, and the maps
compose by a parallel prefix scan. With its entry state known, each chunk runs once more and emits its marks.

The second reads the bytes of a pretoken and annotates each transition with the change in the number of tokens. Its states are
prefixes, made when they are first needed: the last token of a prefix is the one piece ending there that the merges leave
standing beside the last token before it. Transitions on a pretoken's last byte use the word-final pieces. Pretokens
are looked up by their text once they have been counted; both memories are bounded.

Counts equal the library's for the given file: special strings in a text count as one token, as is its default. Null and empty
texts have no tokens. Rows are independent: repeated rows give repeated results, a null id stays null.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import byte_letters, documents, id_and_text, span_hashes, spread

LETTER, NUMBER, SPACE, OTHER, SHORT, LONG = range(6)
#: Between pretokens; in letters; in other characters; one or two characters of a contraction still to come.
FREE, LETTERS, OTHERS, ONE, TWO = range(5)
NEXT = np.array(
    [
        [LETTERS, FREE, FREE, OTHERS, ONE, TWO],
        [LETTERS, FREE, FREE, OTHERS, ONE, TWO],
        [LETTERS, FREE, FREE, OTHERS, OTHERS, OTHERS],
        [FREE] * 6,
        [ONE] * 6,
    ],
    np.uint8,
)
MARK = np.array([[1, 1, 0, 1, 1, 1], [0, 1, 0, 1, 1, 1], [1, 1, 0, 0, 0, 0], [0] * 6, [0] * 6], bool)
#: White space of the pattern's \s.
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CHUNK = 1024
MOST_CHARACTERS, MOST_STATES, MOST_PAIRS, MOST_COUNTED = 1_000_000, 300_000, 300_000, 800_000


@lru_cache(1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for each code point.

    Of those that Python's tables don't know the library says it: a letter makes one pretoken with an `a` before it, a number is one
    of its own beside another one, anything else joins a sign before it.
    """
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    newer = [c for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn"]
    tests = "".join(f"a{chr(c)}\n,{chr(c)}\n" for c in newer)
    whole = {tests[a:z] for _, (a, z) in tokenizer().pre_tokenizer.pre_tokenize_str(tests)}
    out[newer] = [LETTER if f"a{chr(c)}" in whole else OTHER if f",{chr(c)}" in whole else NUMBER for c in newer]
    out[BLANKS] = SPACE
    return out


@lru_cache(2)
def tokenizer(path: str | None = None):
    """The library's reading of the file, for its tables of characters."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))


@lru_cache(1)
def lowering():
    from tokenizers import normalizers

    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


def marks(points: np.ndarray) -> np.ndarray:
    """Whether a pretoken starts at each code point."""
    kind = classes()[points]
    after = np.zeros(len(points) + 2, np.uint32)
    after[: len(points)] = points
    one, two = after[1:-1], after[2:]
    quote = points == ord("'")
    short = quote & np.isin(one, [ord(c) for c in "stmd"])
    long = quote & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
    kind[short], kind[long] = SHORT, LONG
    lanes = -(-len(points) // CHUNK)
    lane = np.full(lanes * CHUNK, SPACE, np.uint8)
    lane[: len(points)] = kind
    lane = np.ascontiguousarray(lane.reshape(lanes, CHUNK).T)
    flat, states = NEXT.reshape(-1), np.repeat(np.arange(5, dtype=np.uint8)[:, None], lanes, 1)
    for row in lane:
        states = flat[states * np.uint8(6) + row]
    maps, step = states.T.copy(), 1
    while step < lanes:  # prefix scan: after it, row k maps the first entry state through chunks 0 to k
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    state = np.concatenate([[FREE], maps[:-1, FREE]]).astype(np.uint8)
    out, flags = np.empty(lane.shape, bool), MARK.reshape(-1)
    for k, row in enumerate(lane):
        at = state * np.uint8(6) + row
        out[k], state = flags[at], flat[at]
    return out.T.reshape(-1)[: len(points)]


def kinds(points: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one pretoken of each kind, the kind of each pretoken). Hashes propose what is equal, the characters decide."""
    _, at, inverse = np.unique(span_hashes(points, first, first + size), return_index=True, return_inverse=True)
    lead = at[inverse]
    if (size == size[lead]).all() and np.array_equal(points[spread(first, size)], points[spread(first[lead], size)]):
        return at, inverse
    number: dict[bytes, int] = {}
    texts = [points[a : a + n].tobytes() for a, n in zip(first.tolist(), size.tolist(), strict=True)]
    inverse = np.array([number.setdefault(t, len(number)) for t in texts])
    return np.unique(inverse, return_index=True)[1], inverse


class Merges:
    """The transducer over the bytes of a pretoken."""

    def __init__(self, path: str | None = None):
        import public_tokenizers

        with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
            spec = json.load(f)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]))
        model = spec["model"]
        self.end, self.letters = model["end_of_word_suffix"], byte_letters()
        self.rank, self.parts, pieces = {}, {}, set(self.letters) | {x + self.end for x in self.letters}
        for r, (a, b) in enumerate(model["merges"]):
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(a + b, (r, a, b))
            pieces.add(a + b)
        self.inner = {p for p in pieces if not p.endswith(self.end)}
        self.final = {p.removesuffix(self.end) for p in pieces if p.endswith(self.end)}
        self.longest = max(map(len, self.inner | self.final))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.start()

    def start(self) -> None:
        #: Of each state: the end of its text, the state before its last byte, its last token and its number of tokens.
        self.text, self.before, self.last, self.tokens = [""], [0], [""], [0]
        #: By state << 8 | byte: the next state and the emission, or the emission at the end of the pretoken.
        self.to: dict[int, tuple[int, int]] = {}
        self.finals: dict[int, int] = {}

    def restart(self, state: int) -> int:
        """Forgets all states but those that the next ones after this one can look back to, and gives its new number."""
        chain = [state]
        while chain[-1] and len(chain) <= self.longest:
            chain.append(self.before[chain[-1]])
        kept = [(self.text[k], self.last[k], self.tokens[k]) for k in reversed(chain) if k]
        self.start()
        for text, last, tokens in kept:
            self.before.append(len(self.text) - 1)
            self.text.append(text)
            self.last.append(last)
            self.tokens.append(tokens)
        return len(self.text) - 1

    def stands(self, a: str, b: str) -> bool:
        """Whether the merges leave tokens a and b side by side.

        The merges are undone from the latest; while a merge is undone, the two tokens that then meet must not have a merge of
        their own that comes earlier (or as early and further left).
        """
        if (known := self.pairs.get((a, b))) is not None:
            return known
        left, right, limit = a, b, float("inf")
        while True:
            if self.rank.get((left, right), float("inf")) < limit:
                out = False
                break
            x, y = self.parts.get(left), self.parts.get(right)
            if x is None and y is None:
                out = True
                break
            if y is not None and (x is None or y[0] >= x[0]):
                limit, right = y[0] + 0.5, y[1]
            else:
                limit, left = x[0], x[2]
        if len(self.pairs) > MOST_PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = out
        return out

    def token(self, state: int, letter: str, pieces: set[str], mark: str) -> tuple[str, int]:
        """The last token of the state's text and a letter, and the number of tokens up to there."""
        text, prefix = self.text[state] + letter, [state]
        for _ in range(min(len(text), self.longest) - 1):
            prefix.append(self.before[prefix[-1]])
        for size in range(len(prefix), 0, -1):
            piece, start = text[-size:], prefix[size - 1]
            if piece in pieces and (not start or self.stands(self.last[start], piece + mark)):
                return piece + mark, self.tokens[start] + 1
        raise ValueError(f"no token ends {text!r}")

    def count(self, data: bytes) -> int:
        """Tokens of one pretoken: the sum of what the transitions emit."""
        if len(self.text) > MOST_STATES:
            self.start()
        state, emitted = 0, 0
        for b in data[:-1]:
            if len(self.text) > MOST_STATES:
                state = self.restart(state)
            at = state << 8 | b
            if (step := self.to.get(at)) is None:
                letter = self.letters[b]
                last, tokens = self.token(state, letter, self.inner, "")
                step = self.to[at] = len(self.text), tokens - self.tokens[state]
                self.text.append((self.text[state] + letter)[-self.longest :])
                self.before.append(state)
                self.last.append(last)
                self.tokens.append(tokens)
            state, more = step
            emitted += more
        at = state << 8 | data[-1]
        if (more := self.finals.get(at)) is None:
            more = self.finals[at] = self.token(state, self.letters[data[-1]], self.final, self.end)[1] - self.tokens[state]
        return emitted + more


class Counter:
    """Token counts of texts."""

    def __init__(self, path: str | None = None):
        self.merges, self.known = Merges(path), {}

    def prepared(self, text: str) -> tuple[str, int]:
        """The text as the first transducer reads it, and the number of special tokens taken out."""
        special = 0
        if "<|" in text:
            parts = self.merges.special.split(text)
            special, text = len(parts) - 1, "\n".join(parts)
        return text.lower() if text.isascii() else lowering().normalize_str(text), special

    def buffer(self, texts: list[str]) -> np.ndarray:
        """Counts of texts that are prepared, in one buffer."""
        joined = "\n".join((*texts, ""))
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        start = marks(points)
        stop = start | (classes()[points] == SPACE)
        stop[-1] = True
        stops = np.flatnonzero(stop)
        first = np.flatnonzero(start)
        last = stops[np.searchsorted(stops, first, "right")] if len(first) else first
        at, inverse = kinds(points, first, last - first)
        words = [joined[a:z] for a, z in zip(first[at].tolist(), last[at].tolist(), strict=True)]
        if len(self.known) > MOST_COUNTED:
            self.known.clear()
        for w in words:
            if w not in self.known:
                self.known[w] = self.merges.count(w.encode("utf-8", "surrogatepass"))
        counts = np.array([self.known[w] for w in words], np.int64)[inverse] if words else np.zeros(0, np.int64)
        edges = np.cumsum([len(t) + 1 for t in texts])
        return np.bincount(np.searchsorted(edges, first, "right"), counts, len(texts)).astype(np.int64)

    def __call__(self, texts: list[str]) -> list[int]:
        ready = [self.prepared(t) for t in texts]
        out, low = [], 0
        while low < len(ready):
            high, size = low, 0
            while high < len(ready) and (high == low or size + len(ready[high][0]) <= MOST_CHARACTERS):
                size += len(ready[high][0])
                high += 1
            found = self.buffer([t for t, _ in ready[low:high]])
            out += [int(n) + s for n, (_, s) in zip(found, ready[low:high], strict=True)]
            low = high
        return out


@lru_cache(1)
def counter(path: str | None = None) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, vocabulary_path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = np.array(tokens(texts), np.int64)
            size = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
