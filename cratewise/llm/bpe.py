"""BPE encoding and decoding (operator 6): prefix-sharing trie traversal.

Of every prefix of a symbol sequence, BPE fixes the last token: it is the one token ``t`` that ends the
prefix, such that ``t`` and the last token of what stands before it do not merge otherwise. So the state
of a trie node is one token, and the encoding of a word is the chain of states on its path. Distinct
words of a batch are put into a trie; a depth-first walk gives every node its state once, however many
words share it. A trie whose leaves are visited in order is the sorted word list with a stack: descending
pushes states, returning pops them down to the prefix shared with the next word.

Texts are cut at ASCII white space, which the supported tokenizers drop before BPE and which no token
contains. Word results are remembered within a worker, up to a fixed number of words.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from cratewise.llm.common import WordMemory, in_worker, steps, text_bytes

# Words whose encoding a worker remembers, in each of two generations; results do not depend on it.
REMEMBERED_WORDS = 200_000
# Pairs of tokens that were tried side by side, and steps from token to token. Past that a worker starts anew.
REMEMBERED_PAIRS = 400_000

_ALONE = -1


class TrieBpe:
    """A BPE tokenizer from its JSON description, with the normaliser and splitter of the library.

    Supported: models without drop-out, unknown token, byte fallback or sub-word prefix, whose splitter
    drops white space, and plain special tokens. Others raise ``ValueError``.
    """

    def __init__(self, description: str) -> None:
        spec = json.loads(description)
        model = spec["model"]
        if model.get("type") != "BPE" or any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        ):
            raise ValueError("only plain BPE models are supported")
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise ValueError("ids are packed as on little-endian machines with 4-byte integers")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("only plain special tokens are supported")
        if spec.get("decoder") or spec.get("post_processor"):
            raise ValueError("decoders and post-processors are not supported")
        self._library = Tokenizer.from_str(description)
        self._library.no_truncation()
        self._library.no_padding()
        ids = lambda text: self._library.encode(text, add_special_tokens=False).ids
        if ids(" ab\n\t\rc \x0b\x0c") != ids("ab") + ids("c"):
            raise ValueError("the tokenizer keeps white space")

        suffix = model.get("end_of_word_suffix") or ""
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        vocab = {k: v for k, v in model["vocab"].items() if k not in self._special}
        self._inner = {k: v for k, v in vocab.items() if not suffix or not k.endswith(suffix)}
        # The tokens that can end a word, without the mark of a word's end.
        self._final = {k.removesuffix(suffix): v for k, v in vocab.items() if k.endswith(suffix)} if suffix else self._inner
        self._suffix, self._vocab = suffix, vocab
        self._longest = max(map(len, self._final), default=1)
        # Beginnings of tokens, and what follows from each with a letter.
        self._begins = {k[:n] for k in self._inner for n in range(1, len(k) + 1)}
        self._steps: dict[tuple[str, str], tuple[str, tuple[tuple[int, int], ...]]] = {}
        self._strings = {v: k for k, v in vocab.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self._fits: dict[tuple[int, int], bool] = {}
        self._memory = WordMemory(REMEMBERED_WORDS)
        self._tokens = {v: k.encode() for k, v in (vocab | self._special).items()}

        patterns = [p["pattern"]["Regex"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split" and "Regex" in p["pattern"]]
        kinds = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        steps_ = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        # For printable Latin-1 words, normalising is lower() and splitting is this pattern.
        self._pattern = regex.compile(patterns[0]) if kinds == ["Split", "ByteLevel"] and steps_ == ["NFC", "Replace", "Lowercase"] else None
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in visible)}
        self._byte_text = [shifted.get(b, chr(b)) for b in range(256)]

    def _symbols(self, token: int) -> list[int]:
        text = self._strings[token]
        ends = bool(self._suffix) and text.endswith(self._suffix)
        parts = list(text.removesuffix(self._suffix) if ends else text)
        if ends:
            parts[-1] += self._suffix
        return [self._vocab[p] for p in parts]

    def _merged(self, symbols: list[int]) -> list[int]:
        """BPE by its definition: merge the pair of lowest rank, the leftmost first, while there is one."""
        while len(symbols) > 1:
            found = [(self._merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self._merges]
            if not found:
                break
            i = min(found)[1]
            symbols[i : i + 2] = [self._merges[symbols[i], symbols[i + 1]][1]]
        return symbols

    def _check(self, before: int, token: int) -> bool:
        """Whether BPE leaves the two tokens as they are, side by side."""
        if before == _ALONE:
            fits = self._merged(self._symbols(token)) == [token]
        else:
            fits = self._merged(self._symbols(before) + self._symbols(token)) == [before, token]
        if len(self._fits) >= REMEMBERED_PAIRS:
            self._fits.clear()
        self._fits[before, token] = fits
        return fits

    def _suffixes(self, state: str, letter: str) -> tuple[str, tuple[tuple[int, int], ...]]:
        """After ``state`` and a letter: the longest end of both that begins a token, and the (length, id) of
        the tokens that stand at the end of it, the longest first."""
        text = state + letter
        while text and text not in self._begins:
            text = text[1:]
        found = [(len(text) - i, self._inner[text[i:]]) for i in range(len(text)) if text[i:] in self._inner]
        if len(self._steps) >= REMEMBERED_PAIRS:
            self._steps.clear()
        step = self._steps[state, letter] = text, tuple(found)
        return step

    def encode_sorted(self, pieces: Iterable[str]) -> Iterator[list[int]]:
        """Ids of words in byte-level letters, which come in order: the walk over their trie."""
        final, fits, check, longest = self._final, self._fits, self._check, self._longest
        steps_, suffixes = self._steps, self._suffixes
        # Of the prefixes on the path: last token, where it begins, and the end of it that may begin a token.
        last, begin, ends = [_ALONE], [0], [""]
        previous = ""
        for piece in pieces:
            end = len(piece) - 1
            depth, most = 0, min(len(last) - 1, end)
            while depth < most and piece[depth] == previous[depth]:
                depth += 1
            del last[depth + 1 :], begin[depth + 1 :], ends[depth + 1 :]
            state = ends[depth]
            for stop in range(depth, end):
                step = state, piece[stop]
                state, found = steps_.get(step) or suffixes(*step)
                for length, token in found:
                    before = last[stop + 1 - length]
                    fit = fits.get((before, token))
                    if fit or fit is None and check(before, token):
                        break
                else:
                    raise ValueError(f"no token for {piece!r}")
                last.append(token)
                begin.append(stop + 1 - length)
                ends.append(state)
            for start in range(max(0, end + 1 - longest), end + 1):
                token = final.get(piece[start:])
                if token is not None:
                    before = last[start]
                    fit = fits.get((before, token))
                    if fit or fit is None and check(before, token):
                        break
            else:
                raise ValueError(f"no token for {piece!r}")
            ids = [token]
            while start:
                ids.append(last[start])
                start = begin[start]
            ids.reverse()
            yield ids
            previous = piece

    def _pieces(self, word: bytes) -> list[str | int]:
        """What BPE gets of a word: pieces in byte-level letters, and ids of special tokens."""
        text = word.decode()
        if self._cut and "<" in text or self._pattern is None or not text.isprintable() or max(text) > "\xff":
            out: list[str | int] = []
            for part in self._cut.split(text) if self._cut else [text]:
                if part in self._special:
                    out.append(self._special[part])
                elif part:
                    normal = self._library.normalizer.normalize_str(part) if self._library.normalizer else part
                    out += [p for p, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]
            return out
        text = text.lower()
        found = [text] if text.isalpha() else self._pattern.findall(text)
        if text.isascii():  # the same letters at byte level
            return found
        letters = self._byte_text
        return ["".join([letters[b] for b in p.encode()]) for p in found]

    def _learn(self, new: set[bytes]) -> None:
        plain = self._pattern is not None
        cut: dict[bytes, str | list[str | int]] = {}
        distinct: set[str] = set()
        for word in new:
            if plain and word.isalpha():  # ASCII letters only
                piece = word.decode().lower()
                distinct.add(piece)
                cut[word] = piece
            else:
                parts = self._pieces(word)
                distinct.update([p for p in parts if isinstance(p, str)])
                cut[word] = parts
        pieces = sorted(distinct)
        coded = {p: array("I", ids).tobytes() for p, ids in zip(pieces, self.encode_sorted(pieces))}
        known = self._memory.known
        for word, parts in cut.items():
            if isinstance(parts, str):
                known[word] = coded[parts]
            else:
                known[word] = b"".join([coded[p] if isinstance(p, str) else p.to_bytes(4, "little") for p in parts])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out = []
        for first, last in steps(texts):
            split = [text.split() for text in texts[first:last]]
            new = self._memory.missing(set().union(*split))
            if new:
                self._learn(new)
            find = self._memory.known.__getitem__
            out += [b"".join(map(find, row)) for row in split]
        return out

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: the tokens as they are, joined by spaces; unknown ids are left out."""
        values = np.frombuffer(ids, "<u4").tolist()
        try:
            return b" ".join(map(self._tokens.__getitem__, values))
        except KeyError:
            return b" ".join([self._tokens[v] for v in values if v in self._tokens])


def tokenizer(description: str) -> TrieBpe:
    """The worker's tokenizer of that description."""
    return in_worker(("trie", description), lambda: TrieBpe(description))


def read_description(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def bpe_encode(docs: DataFrame, description: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Add ``into``: the ids of ``text`` as a binary of little-endian unsigned 32-bit integers.

    NULL and empty texts have no ids (an empty binary). Rows are independent of each other, so repeated
    rows stay, other columns pass through, and a column that is already called ``into`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(description)  # one vocabulary file
    kept = docs.drop(into)
    place = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = tokenizer(shared.value)
        for batch in batches:
            texts = text_bytes(batch.column(place))
            for first, last in steps(texts):
                ids = pa.array(engine.encode(texts[first:last]), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns, ids], [*batch.schema.names, into])

    return kept.mapInArrow(run, _with(kept, into, "binary"))


def bpe_decode(docs: DataFrame, description: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add ``into``: the text of ``ids``, special tokens included. NULL ids decode to an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(description)
    kept = docs.drop(into)
    place = kept.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = tokenizer(shared.value)
        for batch in batches:
            coded = [value or b"" for value in batch.column(place).to_pylist()]
            for first, last in steps(coded):
                column = pa.array(map(engine.decode, coded[first:last]), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(first, last - first).columns, column], [*batch.schema.names, into])

    return kept.mapInArrow(run, _with(kept, into, "string"))


def _with(df: DataFrame, name: str, kind: str) -> str:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*fields, f"`{name}` {kind}"])


def bpe_digests(docs: DataFrame, description: str) -> DataFrame:
    """Per document of (doc_id, text): number of ids, and SHA-256 of the ids and of the decoded text.

    Encoding and decoding share a task and its tokenizer; ids and texts of a few MB are held at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(description)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = tokenizer(shared.value)
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for first, last in steps(texts):
                ids = engine.encode(texts[first:last])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0)[first:last],
                        "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                        "decoded_sha256": [hashlib.sha256(engine.decode(x)).hexdigest() for x in ids],
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, names)
