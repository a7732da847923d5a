"""Exact token counts of every prefix, by dynamic programming.

Two levels.  A text falls into chunks that the tokenizer treats alike alone and in their text, so
the count at the end of chunk k is the count at the end of chunk k - 1 plus that of the chunk: a
running sum, kept per document.  Within a chunk, ``PrefixTable`` keeps, for every prefix of a
pre-token, the last token of its encoding: of all tokens that end there, the one that the token
before it leaves standing.  A count is then one more than the count before that token.
The count of a whole chunk, once per distinct chunk of a worker, is the last of its prefixes, and
questions about budgets and cuts are answered from these tables too.  The tokenizers library counts
distinct chunks only to check them: a difference fails the task.

Null texts are empty and have no tokens.  Very long texts are taken in slices of whole rows; a
single row is held as a whole.  Repeated rows are counted each; other columns stay as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stagehouse.llm.encoding import ChunkEncoder, encoder, tokenizer_path
from stagehouse.llm.storage import map_batches
from stagehouse.llm.text import chunk_spans, rows_of, text_slices

#: Fixed value: the pre-token pattern of byte-level vocabularies.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else
    the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in prints else free))
        free += b not in prints
    return out


class PrefixTable:
    """Counts for every prefix of a text by a byte-level vocabulary with ranked merges."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        number = spec["model"]["vocab"]
        names = {t: bytes(byte[c] for c in t) for t in number if byte.keys() >= set(t)}
        self.size = max(number.values()) + 1
        # by number of a token: its halves and the rank of the merge that makes it, -1 for a byte
        self.left, self.right, self.made = ([-1] * self.size for _ in range(3))
        self.rank: dict[int, int] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            whole = number[a + b]
            self.rank[number[a] * self.size + number[b]] = r
            self.left[whole], self.right[whole], self.made[whole] = number[a], number[b], r
        self.number = {
            name: number[t] for t, name in names.items() if len(name) == 1 or self.made[number[t]] >= 0
        }
        # lengths, from 3 on, of the tokens that end in three given bytes, the longest first
        sizes: dict[bytes, set[int]] = {}
        for name in self.number:
            if len(name) > 2:
                sizes.setdefault(name[-3:], set()).add(len(name))
        self.sizes = {end: (*sorted(found, reverse=True), 2, 1) for end, found in sizes.items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = regex.compile(PRE_TOKENS)
        self.spaces = regex.compile(r"\s+")
        self.stands = lru_cache(1 << 17)(self._stands)
        self._cached = lru_cache(1 << 15)(self._of_pre_token)

    def _stands(self, border: int) -> bool:
        """No merge across the border of two tokens (left * size + right) comes before those that
        made them."""
        left, right = divmod(border, self.size)
        limit = len(self.rank)
        while True:
            if self.rank.get(left * self.size + right, limit) < limit:
                return False
            made_left, made_right = self.made[left], self.made[right]
            if made_left > made_right:
                limit = made_left
                left = self.right[left]
            else:
                if made_right < 0:
                    return True
                limit = made_right + 1
                right = self.left[right]

    def of_pre_token(self, token: str) -> list[int]:
        """Counts after each byte of a pre-token; index 0 is the empty prefix."""
        return self._cached(token) if len(token) <= 64 else self._of_pre_token(token)

    def _of_pre_token(self, token: str) -> list[int]:
        count, last = [0], [-1]
        self._extend(token.encode(), count, last)
        return count

    def _extend(self, text: bytes, count: list[int], last: list[int]) -> None:
        """Carries the counts, and the last token, of the first prefixes of ``text`` on to all."""
        number, sizes, size, stands = self.number, self.sizes, self.size, self.stands
        for end in range(len(count), len(text) + 1):
            for length in sizes.get(text[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                start = end - length
                if start < 0:
                    continue
                piece = number.get(text[start:end])
                if piece is not None and (not start or stands(last[start] * size + piece)):
                    count.append(count[start] + 1)
                    last.append(piece)
                    break
            else:
                raise ValueError(f"the vocabulary has no token for a byte of {text!r}")

    def totals(self, chunks: list[str]) -> list[int]:
        """The count of each whole chunk.  Their pre-tokens are taken in order of their bytes, so that
        each goes on from the table of the prefix it shares with the one before."""
        split, extra = [], []
        for chunk in chunks:
            if any(special in chunk for special in self.special):
                parts = self._split(chunk)
                split.append([t for t, special in parts if not special])
                extra.append(len(parts) - len(split[-1]))
            else:
                split.append(self.pattern.findall(chunk))
                extra.append(0)
        whole = {}
        count, last, before = [0], [-1], b""
        for token in sorted({t for parts in split for t in parts}):
            text = token.encode()
            same = 0
            for a, b in zip(text, before, strict=False):
                if a != b:
                    break
                same += 1
            del count[same + 1 :], last[same + 1 :]
            self._extend(text, count, last)
            whole[token] = count[-1]
            before = text
        return [n + sum(whole[t] for t in parts) for n, parts in zip(extra, split, strict=True)]

    def of_chunk(self, chunk: str) -> list[int]:
        """Counts after each character of a chunk; index 0 is the empty prefix.  In linear time: what a
        prefix cuts differently is white space, the beginning of a contraction or of a special string,
        and all three are taken from where they begin."""
        out = [0]
        done = base = 0
        ordinary = 0  # where the text without special strings began
        for token, special in self._split(chunk):
            counts = None if special else self.of_pre_token(token)
            size = 0
            for i, letter in enumerate(token, 1):
                size += len(letter.encode())
                whole = i == len(token)
                if special and not whole:
                    out.append(out[ordinary] + self._alone(chunk[ordinary : done + i]))
                elif special:
                    out.append(base + 1)
                elif token[0] == "'" and not whole:
                    out.append(base + self._alone(token[:i]))
                else:
                    out.append(base + counts[size])
            done += len(token)
            base = out[-1]
            if special:
                ordinary = done
        return self._settle(chunk, out)

    def _settle(self, chunk: str, out: list[int]) -> list[int]:
        """A prefix that ends within or after white space has all of it as one pre-token."""
        for run in self.spaces.finditer(chunk):
            counts = self.of_pre_token(run[0])
            base, size = out[run.start()], 0
            for i, letter in enumerate(run[0], 1):
                size += len(letter.encode())
                out[run.start() + i] = base + counts[size]
        return out

    def _split(self, text: str) -> list[tuple[str, bool]]:
        out, at = [], 0
        while at < len(text):
            places = [(p, s) for s in self.special if (p := text.find(s, at)) >= 0]
            place, special = min(places, default=(len(text), ""))
            out += [(t, False) for t in self.pattern.findall(text[at:place])]
            out += [(special, True)] * bool(special)
            at = place + len(special)
        return out

    def _alone(self, text: str) -> int:
        return sum(1 if s else self.of_pre_token(t)[-1] for t, s in self._split(text))


class PrefixEncoder(ChunkEncoder):
    """Counts chunks by their prefix tables.  The tokenizers library is asked as well, as a check."""

    batch = 20_000  # the more chunks at once, the more they share

    def _found(self, chunks: list[str]) -> tuple[list[int], None]:
        counts = prefix_table(self.path).totals(chunks)
        for chunk, n, own in zip(chunks, counts, super()._found(chunks)[0], strict=True):
            if n != own:
                raise ValueError(f"{n} tokens by prefix tables, {own} by the library, in {chunk!r}")
        return counts, None


_tables: dict[str, PrefixTable] = {}


def prefix_table(path: str) -> PrefixTable:
    if path not in _tables:
        _tables[path] = PrefixTable(path)
    return _tables[path]


def count_tokens(
    docs: DataFrame,
    *,
    limit: int = 1024,
    tokenizer: str | None = None,
    keep_prefixes: bool = False,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` without the text, with

    * ``n_bytes``, ``n_tokens`` and ``over_limit`` of the whole text,
    * ``fit_chars``: the longest prefix, in code points, of at most ``limit`` tokens,
    * with ``keep_prefixes``, ``prefix_tokens``: the count at every code point, 0 first.

    Columns of these names in ``docs`` give way.  ``tokenizer`` is the file of a byte-level vocabulary
    with ranked merges.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    made = ["n_bytes long", "n_tokens long", "over_limit boolean", "fit_chars long"]
    made += ["prefix_tokens array<int>"] * keep_prefixes
    names = {m.split()[0] for m in made}
    kept = [c for c in docs.columns if c not in names and c != text_column]
    picked = docs.select(*[f"`{c}`" for c in kept], f"`{text_column}`")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, with_ids=False, kind=PrefixEncoder)
        for part, data, bounds in text_slices(batches, text_column):
            starts, ends = chunk_spans(data, bounds)
            after = np.concatenate([[0], np.cumsum(encode.counts_of(data, starts, ends))])
            first = np.searchsorted(starts, bounds)  # the first chunk of each row
            tokens = after[first[1:]] - after[first[:-1]]
            letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            fit = letters[bounds[1:]] - letters[bounds[:-1]]
            for row in np.flatnonzero(tokens > limit):
                base = after[first[row]]
                stop = int(np.searchsorted(after, base + limit, "left")) - 1
                at = starts[stop]
                inside = prefix_table(path).of_chunk(data[at : ends[stop]].tobytes().decode())
                most = base + limit - after[stop]
                more = max(i for i, n in enumerate(inside) if n <= most)
                fit[row] = letters[at] - letters[bounds[row]] + more
            columns = [part.column(i) for i in range(part.num_columns - 1)]
            columns += [np.diff(bounds), tokens, tokens > limit, fit]
            if keep_prefixes:
                columns.append(
                    pa.array(
                        [
                            prefixes(path, data, starts[a:b], ends[a:b], after[a : b + 1])
                            for a, b in zip(first[:-1], first[1:], strict=True)
                        ],
                        pa.list_(pa.int32()),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                names=[*kept, *(m.split()[0] for m in made)],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:-1]]
    return map_batches(picked, count, ", ".join([*fields, *made]))


def prefixes(path: str, data: np.ndarray, starts, ends, after) -> list[int]:
    out = [0]
    table = prefix_table(path)
    for a, b, n in zip(starts, ends, after, strict=False):
        out += [int(n - after[0]) + i for i in table.of_chunk(data[a:b].tobytes().decode())[1:]]
    return out


def cut_at(prefix_tokens: list[int], budget: int) -> int:
    """The longest prefix of at most ``budget`` tokens, from a stored table."""
    return max(i for i, n in enumerate(prefix_tokens) if n <= budget)
