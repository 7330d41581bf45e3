"""Byte-pair encoding without merging: one token per prefix, found by dynamic programming.

The token that ends the encoding of a prefix is unique. A suffix automaton over the vocabulary (Aho-Corasick: each state is
the longest suffix read so far that begins a token, its suffix links list the tokens that end here) proposes tokens, and a
token is taken when it is compatible with the token stored for the prefix before it: no merge across their border would come
before both are complete. Following the stored tokens back from the end gives the ids that merging pair by pair would give.

Texts are cut and normalised as the tokenizer file says (special tokens of the raw text, NFC, white space, lower case, words).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablejobs.llm import text as T

END = "\n"  # stands for the word end in the automaton; no byte is written so
MEMO_WORDS = MEMO_PARTS = 150_000  # words and pieces whose ids a worker keeps; a full memory is emptied and filled anew
MEMO_LENGTH = 64
PLAIN = "\u2500"  # texts below this code point are normalised here, others by the tokenizers library


def byte_letters() -> list[str]:
    """The letter that writes each byte: itself where it is printable, else the next free code point from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model, self.path = content["model"], path
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        split = next(p for p in content["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"], regex.V0).findall
        self.spaces = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
        self.letters = byte_letters()
        self.ascii = {b: self.letters[b] for b in range(128)}
        # A token: text, whether it ends a word, and its ends while it grew, each with the rank of the merge that ended it.
        self.rank: dict[tuple[int, int], int] = {}
        self.right: dict[int, list[tuple[int, float]]] = {}
        self.left: dict[int, list[tuple[int, float]]] = {}
        never = float("inf")
        plain, closes = {}, {}
        for letter in self.letters:
            for text, close in ((letter, False), (letter + suffix, True)):
                if (i := vocab.get(text)) is not None:
                    plain[i], closes[i] = letter, close
                    self.right[i] = self.left[i] = [(i, never)]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            one, two, both = vocab[a], vocab[b], vocab[a + b]
            self.rank[one, two] = rank
            plain[both], closes[both] = plain[one] + plain[two], closes[two]
            self.right[both] = [*self.right[two][:-1], (two, rank), (both, never)]
            self.left[both] = [*self.left[one][:-1], (one, rank), (both, never)]
        self.automaton = ahocorasick.Automaton()
        for i, text in plain.items():
            self.automaton.add_word(text + END * closes[i], (i, len(text)))
        self.automaton.make_automaton()
        self.fits_memo: dict[int, bool] = {}
        self.word_memo: dict[str, list[int]] = {}
        self.part_memo: dict[str, list[int]] = {}
        self._library = None

    def fits(self, a: int, b: int) -> bool:
        """Whether a and b can stand side by side: no merge of their growing ends comes before both have grown on.

        Of equal merges the left one goes first, so a's own growth wins a tie and b's does not.
        """
        rank = self.rank
        found = True
        for x, grows_x in self.right[a]:
            for y, grows_y in self.left[b]:
                r = rank.get((x, y))
                if r is not None and r < grows_x and r <= grows_y:
                    found = False
        if len(self.fits_memo) > 2 * MEMO_PARTS:
            self.fits_memo.clear()
        self.fits_memo[a << 20 | b] = found
        return found

    def word(self, word: str) -> list[int]:
        """Ids of one word, written in byte letters."""
        n = len(word)
        last, begins = [-1] * (n + 1), [0] * (n + 1)  # of each prefix: its last token and where that begins
        known = self.fits_memo.get
        for end, (token, length) in self.automaton.iter(word + END):
            i = end + 1
            if i >= n:
                if i == n:
                    continue  # a token that doesn't end words, at the end of this one
                i = n
            if last[i] >= 0:
                continue
            j = i - length
            if j:
                before = last[j]
                if before < 0:
                    continue
                good = known(before << 20 | token)
                if good is None:
                    good = self.fits(before, token)
                if not good:
                    continue
            last[i] = token
            begins[i] = j
        ids, i = [], n
        while i:
            if last[i] < 0:
                raise ValueError(f"the vocabulary can't write {word!r}")
            ids.append(last[i])
            i = begins[i]
        ids.reverse()
        return ids

    def part(self, part: str) -> list[int]:
        """Ids of a piece of normalised text."""
        ids: list[int] = []
        memo = self.word_memo
        for word in self.words(part):
            known = memo.get(word)
            if known is None:
                if word.isascii():
                    known = self.word(word.translate(self.ascii))
                else:
                    known = self.word("".join([self.letters[b] for b in word.encode()]))
                if len(word) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = known
            ids += known
        return ids

    def normal(self, text: str) -> str:
        try:
            text.encode("latin-1")
            return text.lower()  # nothing to compose; white space only separates
        except UnicodeEncodeError:
            pass
        if max(text) < PLAIN:
            # Letter by letter: Python's lower() would look at the letters around a capital sigma.
            return self.spaces.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).normalizer
        return self._library.normalize_str(text)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text. No word holds a blank, so pieces between blanks are encoded once and remembered."""
        ids: list[int] = []
        memo = self.part_memo
        for run in self.cut.split(text) if text and "<|" in text else [text or ""]:
            if run in self.special:
                ids.append(self.special[run])
                continue
            for part in self.normal(run).split(" "):
                known = memo.get(part)
                if known is None:
                    known = self.part(part)
                    if len(part) <= MEMO_LENGTH:
                        if len(memo) >= MEMO_PARTS:
                            memo.clear()
                        memo[part] = known
                ids += known
        return ids

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: tokens, special ones included, joined by a blank."""
        return " ".join(map(self.token.__getitem__, ids))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row: the ids of the whole text, an empty array for a null or empty one. ``path`` names the
    tokenizer file on every executor. Rows are independent, so repeated or null ids are kept as they come."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in found:
            ids = pa.array([np.array(tool.encode(t.as_py()), np.int32) for t in batch["text"]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return given.mapInArrow(batches, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row of ids; a null array gives an empty text."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in found:
            texts = pa.array([tool.decode(ids.as_py() or []) for ids in batch["ids"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], texts], ["doc_id", "text"])

    given = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))
    return given.mapInArrow(batches, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, text string")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded_sha256) of every row: the ids of the whole text and the digest of the text they decode to. Null and
    empty texts have an empty array and the digest of the empty text; repeated or null ids are kept as they come."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in T.small_batches(found, "text"):
            written, read = [], []
            for text in batch["text"]:
                ids = tool.encode(text.as_py())
                written.append(np.array(ids, np.int32))
                read.append(_sha(tool.decode(ids)))
            columns = [batch["doc_id"], pa.array(written, pa.list_(pa.int32())), pa.array(read, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded_sha256"])

    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(batches, f"doc_id {kind}, ids array<int>, decoded_sha256 string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encodes and decodes in one pass, so that no ids travel
    between the two steps. Null and empty texts have no tokens; repeated or null ids are kept as they come."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in found:
            counts, written, read = [], [], []
            for text in batch["text"]:
                ids = tool.encode(text.as_py())
                counts.append(len(ids))
                written.append(_sha(" ".join(map(str, ids))))
                read.append(_sha(tool.decode(ids)))
            columns = [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(read, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    given = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(batches, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
