"""Ids of whole texts by a tokenizers-library vocabulary that drops white space."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import arrow_of, batch_of, giving_back, held, texts
from stemma.session import write_out

#: Entries a worker remembers of each kind; a full memory keeps the pieces of the last batch, if they are fewer.
REMEMBERED = 300_000
#: Strings of this many characters or more are encoded anew each time, so the bytes remembered are bounded too.
LONGEST = 64
#: Rows that a Parquet reader decodes at once; it holds their texts or ids in one array, which doubles as it grows.
READ_ROWS = 512
#: What a token that ends a piece ends with.
_WORD_END = "</w>"
#: The id that ends a document.
END_ID = 1
#: Separators that Python and Arrow split at and the tokenizer does not; such texts go to the library whole.
_ODD = "[\x1c-\x1f]"
#: Strings whose pieces the library treats alone: printable ASCII and accented Latin-1 letters, without the brackets of special tokens.
_PLAIN = rf"\A[!-;=-~À-ÖØ-öø-ÿ]{{1,{LONGEST - 1}}}\z"
#: The pre-tokenizer's pattern for such strings in lower case, and the line feed that is put between them.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+|\n")


class WordIds:
    """Encodes texts with the library and remembers the ids of pieces, and of parts it doesn't cut.

    The vocabulary's normalizer turns white space to blanks and its
    pre-tokenizer drops them, so ids of a text are the ids of its parts between
    white space, one after another. Each distinct part of a batch is cut into
    pieces once; pieces seen before cost a lookup, new ones go to the library's
    model. Parts with other characters go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # the same model for pieces, which are normalized and cut already
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.library.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < (1 << 16) - 1 else "<u4")
        self.mark = np.iinfo(self.kind).max  # stands for a line feed, no id
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.parts: dict[str, bytes] = {}
        self.line = np.array([self.mark], self.kind).tobytes()
        self.pieces: dict[str, bytes] = {"\n": self.line}

    def by_library(self, strings: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def by_parts(self, parts: list[str]) -> pa.Array:
        """Ids of any parts."""
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        short = [p for p in parts if len(p) < LONGEST and p not in self.parts]
        self.parts.update(zip(short, self.by_library(short), strict=True))
        long = [p for p in parts if len(p) >= LONGEST]
        found = dict(zip(long, self.by_library(long), strict=True))
        return pa.array([found[p] if len(p) >= LONGEST else self.parts[p] for p in parts], pa.large_binary())

    def by_pieces(self, parts: pa.Array) -> pa.Array:
        """Ids of plain parts in lower case."""
        # a line feed after each; joined by Arrow, which makes no string of each part
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(parts)], parts), "\n")[0].as_py() + "\n" * bool(len(parts))
        pieces = _PIECES.findall(lines)
        seen = set(pieces)
        if new := list(seen.difference(self.pieces)):
            ids = np.array(self.model.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, dtype=self.kind)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            ids = ids.tobytes()
            self.pieces.update(zip(new, [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        # the line feeds' places tell where a part's ids end
        found = np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), self.kind)
        if len(self.pieces) > REMEMBERED:
            kept = {p: self.pieces[p] for p in seen} if len(seen) <= REMEMBERED else {}
            self.pieces = {**kept, "\n": self.line}
        at = np.flatnonzero(found == self.mark)
        offsets = np.concatenate([np.zeros(1, np.int64), at - np.arange(len(at))]) * self.kind.itemsize
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(found[found != self.mark])])

    def encode(self, strings: list[str] | pa.Array) -> list[bytes]:
        """Little-endian ids of each text, two bytes an id where the vocabulary allows."""
        strings = strings if isinstance(strings, pa.Array) else pa.array(strings, pa.string())
        odd = pc.match_substring_regex(strings, _ODD)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        lists = pc.utf8_split_whitespace(pc.if_else(odd, "", strings) if whole else strings)
        coded = lists.flatten().dictionary_encode()
        parts = coded.dictionary
        plain = pc.match_substring_regex(parts, _PLAIN)
        ids = self.by_pieces(pc.utf8_lower(parts.filter(plain)))
        ids = pa.concat_arrays([ids, self.by_parts(parts.filter(pc.invert(plain)).to_pylist())])
        place = np.empty(len(parts), np.int64)
        place[np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(parts))
        ids = ids.take(pa.array(place[coded.indices.to_numpy()]))
        # a text's ids lie between those of its first and of its last part
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset :] if len(ids) else np.zeros(1, np.int64)
        ends = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist() if len(strings) else [0]
        data = memoryview(data or b"")
        out = [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        for i, x in zip(whole, self.by_library([strings[i].as_py() for i in whole]), strict=True):
            out[i] = x
        return out


_IDS = arrow_of("doc_id long, width int, ids binary")


def token_ids(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """``row_id``, ``doc_id`` and ``ids`` of every whole text with ``end_id`` appended, written once.

    ``vocabulary`` is a path each worker can read (a file of the installed
    tokenizer package). ``ids`` holds little-endian ids of ``width`` bytes. Null
    texts count as empty and give the end id alone; rows whose ``doc_id`` is null
    or repeats stay separate rows, told apart by ``row_id``.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(("word ids", vocabulary), lambda: WordIds(vocabulary))
        end = np.array([end_id], dtype=known.kind).tobytes()
        for batch in batches:
            ids, bodies = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            yield batch_of(_IDS, ids, [known.kind.itemsize] * len(ids), [x + end for x in known.encode(bodies)])
        batch = ids = bodies = None
        giving_back()  # an executor can have more workers than tasks at a time; the others wait

    docs.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
    found = texts(docs).mapInArrow(encode, "doc_id long, width int, ids binary")
    return write_out(found.withColumn("row_id", F.monotonically_increasing_id()), "token-ids")


def as_array(ids: bytes, width: int) -> np.ndarray:
    return np.frombuffer(ids, dtype=f"<u{width}")
