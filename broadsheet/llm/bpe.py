"""BPE encoding and decoding of whole texts with a vocabulary file.

A short word is held as a contiguous array of its parts beside the ranks of
adjacent parts. The smallest rank is looked for again and again, the boundary
behind it deleted and the ranks on both sides refreshed. All new short words of
a batch take these steps together, as the rows of a matrix. Words of more than
``SHORT`` bytes take the same steps from a heap, so that a very long word
costs n log n.

Texts are cut at white space first, and the ids of such pieces are kept in a
dictionary of bounded size, per task; it changes the speed only.

The format is a tokenizers JSON file of the word BPE kind: NFC, white space
dropped, lower case, the file's own split pattern, bytes as characters, a word
end mark. Null texts count as empty and have no ids. White-space characters are
those of the Unicode property White_Space.
"""

import hashlib
import heapq
import json
import unicodedata
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from broadsheet.llm.common import map_columns

SHORT = 32
TOGETHER = 20_000  # words of one matrix
CACHED = 400_000  # pieces kept per task
_END = "\ue000"  # one character for the word end mark; no byte has it
_PIECE = regex.compile(r"\P{White_Space}+")
_OTHER_SPACES = regex.compile(r"[\x1c-\x1f]")


@cache
def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it prints, else the next one above 255."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(prints) else chr(next(rest)) for b in range(256)]


class Codec:
    """The vocabulary of a file, with ``encode`` and ``decode``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        mark = model["end_of_word_suffix"]
        if not mark or content["decoder"] is not None:
            raise ValueError("not a word BPE file")
        vocab, chars = model["vocab"], byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + mark] for c in chars], np.int64)
        pairs = np.array([(vocab[a] << 20) | vocab[b] for a, b in model["merges"]], np.int64)
        self.made = np.array(
            [vocab[a + b] for a, b in model["merges"]] + [-1], np.int64
        )
        self.order = np.argsort(pairs, kind="stable")
        self.pairs = pairs[self.order]
        self.none = len(pairs)
        self.tokens = {i: token for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens.update({i: token for token, i in self.special.items()})
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; ``none`` where they don't merge."""
        pair = (left.astype(np.int64) << 20) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), self.none - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.order[at], self.none).astype(np.int32)

    def merge_short(self, words: list[bytes], width: int) -> list[bytes]:
        """The packed ids of words of at most ``width`` bytes, all together."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row, place = np.repeat(np.arange(n), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        parts = np.full((n, width + 1), -1, np.int32)
        parts[row, place] = self.inner[flat]
        ends = np.cumsum(size) - 1
        parts[np.arange(n), size - 1] = self.final[flat[ends]]
        near = self._ranks(parts[:, :-1], parts[:, 1:])
        out = [b""] * n
        who, column = np.arange(n), np.arange(width + 1)
        while len(who):
            at = near.argmin(1)
            here = np.arange(len(who))
            least = near[here, at]
            going = least < self.none
            done = parts[~going]
            raw, step = packed(done), done.shape[1] * 4
            for i, (word, held) in enumerate(zip(who[~going].tolist(), (done >= 0).sum(1).tolist())):
                out[word] = raw[i * step : i * step + held * 4]
            who, at, least, parts, near = who[going], at[going], least[going], parts[going], near[going]
            here = here[: len(who)]
            # delete the boundary behind part ``at``
            behind = column > at[:, None]
            parts[:, :-1] = np.where(behind[:, :-1], parts[:, 1:], parts[:, :-1])
            parts[:, -1] = -1
            parts[here, at] = self.made[least]
            near[:, :-1] = np.where(behind[:, 1:-1], near[:, 1:], near[:, :-1])
            near[:, -1] = self.none
            # refresh the ranks on both sides
            near[here, at] = self._ranks(parts[here, at], parts[here, np.minimum(at + 1, width)])
            inside = at > 0
            left = at[inside] - 1
            near[here[inside], left] = self._ranks(parts[here[inside], left], parts[here[inside], left + 1])
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """The ids of one word; the least rank, leftmost first, comes from a heap."""
        ids = self.inner[np.frombuffer(word, np.uint8)]
        ids[-1] = self.final[word[-1]]
        first = self._ranks(ids[:-1], ids[1:])
        parts, n = ids.tolist(), len(word)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(int(first[i]), int(i), parts[i], parts[i + 1]) for i in np.flatnonzero(first < self.none)]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if parts[i] != a or (j := after[i]) >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    pair = (parts[x] << 20) | parts[y]
                    at = min(int(np.searchsorted(self.pairs, pair)), self.none - 1)
                    if self.pairs[at] == pair:
                        heapq.heappush(heap, (int(self.order[at]), x, parts[x], parts[y]))
        return np.array([p for p in parts if p >= 0], np.int64)

    def _words(self, piece: str) -> list[bytes]:
        """The words of text without white space, as UTF-8."""
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece)
        # characters are lowered one by one; only this one depends on its neighbours
        lower = "".join([c.lower() for c in piece]) if "\u03a3" in piece else piece.lower()
        if lower.isalpha():
            return [lower.encode()]
        return [word.encode() for word in self.words.findall(lower)]

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of new pieces into ``known``."""
        split = {piece: self._words(piece) for piece in pieces}
        words = list(set().union(*split.values()))
        ids: dict[bytes, bytes] = {}
        low = 0
        for width in (8, 16, SHORT):
            some = [w for w in words if low < len(w) <= width]
            low = width
            for at in range(0, len(some), TOGETHER):
                group = some[at : at + TOGETHER]
                ids.update(zip(group, self.merge_short(group, width)))
        for word in words:
            if len(word) > SHORT:
                ids[word] = packed(self.merge_long(word))
        for piece, found in split.items():
            self.known[piece] = ids[found[0]] if len(found) == 1 else b"".join([ids[word] for word in found])

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of texts, each as 32-bit little-endian integers."""
        plain, where = [], []  # parts without special tokens; per text its parts' numbers or ready ids
        for text in texts:
            text = text or ""
            parts = self.specials.split(text) if any(s in text for s in self.special) else [text]
            own: list[int | bytes] = []
            for nth, part in enumerate(parts):
                if nth % 2:
                    own.append(packed([self.special[part]]))
                else:
                    own.append(len(plain))
                    plain.append(_PIECE.findall(part) if _OTHER_SPACES.search(part) else part.split())
            where.append(own)
        needed = set().union(*plain)
        new = needed.difference(self.known)
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = needed
        self._learn(new)
        known = self.known
        encoded = [b"".join([known[piece] for piece in pieces]) for pieces in plain]
        return [b"".join([x if isinstance(x, bytes) else encoded[x] for x in own]) for own in where]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by a space."""
        return " ".join([self.tokens[i] for i in unpacked(ids).tolist()])


def packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit integers, whole text), n_tokens."""

    def rows(codec, doc_ids, texts):
        for doc_id, ids in zip(doc_ids, codec.encode_all(texts)):
            yield doc_id, ids, len(ids) // 4

    return map_columns(docs.select("doc_id", "text"), "doc_id long, ids binary, n_tokens long", rows, lambda: Codec(path))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded text of ``ids``; null ids give an empty text."""

    def rows(codec, doc_ids, ids):
        return ((doc_id, codec.decode(x or b"")) for doc_id, x in zip(doc_ids, ids))

    return map_columns(encoded.select("doc_id", "ids"), "doc_id long, text string", rows, lambda: Codec(path))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them, in one pass."""

    def rows(codec, doc_ids, texts):
        for doc_id, ids in zip(doc_ids, codec.encode_all(texts)):
            decoded = codec.decode(ids)
            yield doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    return map_columns(
        docs.select("doc_id", "text"),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
        rows, lambda: Codec(path),
    )
