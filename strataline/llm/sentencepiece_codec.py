"""SentencePiece merge-type encoding by backtracking, and decoding.

A merge encoder joins the best-scored adjacent pair, leftmost among equals, until no pair is a piece.
Its result is the only split of a text in which every two neighbours, merged again on their own, come
back as the same two pieces. So the encoder walks left to right, tries the longest piece that starts at
a position (found by an Aho-Corasick automaton), then ever shorter ones, keeps the first that is
compatible with its left neighbour, and steps back when none is. A bitfield holds the positions from
which no split of the rest can be reached, so that none is tried twice and the walk stays linear.

Texts are cut first where no piece of the model can lie across the cut; that cannot change the result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Entries of the per-worker table of chunks seen before; it is emptied when full.
CACHE_ENTRIES = 400_000
#: Entries of the per-worker table of neighbours checked before.
PAIR_ENTRIES = 400_000
#: Longer chunks are encoded each time, so that the table's memory is bounded.
CACHE_CHARS = 48
#: A mark is no place to cut if more characters than this stand before it inside pieces.
ODD = 2


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """The fields of a protocol buffer message, as (number, value)."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        elif key & 7 == 2:
            n, at = varint(at)
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[key & 7]
            value, at = data[at : at + n], at + n
        yield key >> 3, value


class Codec:
    """Encodes and decodes as the library does for one merge-type model.

    Supported: merge-type models with the identity normaliser, without user-defined or unused pieces.
    Others raise ValueError. A null text is treated as empty by the callers below; an empty text has no
    ids besides the end id.
    """

    def __init__(self, model: bytes) -> None:
        import struct

        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict[int, object] = {}
        norm: dict[int, object] = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode("utf-8"))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type model")
        if norm.get(2) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24, 0):
            raise ValueError("the model's normaliser is not supported")
        if {USER_DEFINED, UNUSED} & {*self.kinds}:
            raise ValueError("user-defined or unused pieces are not supported")
        self.dummy_prefix = bool(norm.get(3, 1))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = self.kinds.index(UNKNOWN)
        self.unknown_surface = trainer[44].decode() if 44 in trainer else " ⁇ "
        self.end = self.pieces.index("</s>")
        self.score = {p: s for p, s, k in zip(self.pieces, scores, self.kinds, strict=True) if k == NORMAL}
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == NORMAL}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == BYTE}
        self.automaton = ahocorasick.Automaton()
        for p in self.score:
            if len(p) > 1:
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.shorter = {p: next((n for n in range(len(p) - 1, 1, -1) if p[:n] in self.score), 1) if len(p) > 1 else 0 for p in self.score}
        self.chunks, self.fine, self.odd = self._cuts()
        order = sorted({s for p, s in self.score.items() if len(p) > 1}, reverse=True)
        ranks = {s: r for r, s in enumerate(order)}
        self.rank = {p: ranks[s] for p, s in self.score.items() if len(p) > 1}
        seen = Counter(self.rank.values())
        #: Neighbouring characters of pieces whose score another piece has too.
        self.tied = {p[i : i + 2] for p, r in self.rank.items() if seen[r] > 1 for i in range(len(p) - 1)}
        self.halves = lru_cache(None)(self._halves)
        self.known: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.n_known = 0
        self.cache: dict[str, tuple[int, ...]] = {}
        self.text_of = [str(i) for i in range(len(self.pieces))]
        self.surface = [self._surface(i) for i in range(len(self.pieces))]

    def _cuts(self) -> tuple[re.Pattern, re.Pattern | None, str]:
        """How a text may be cut: always, and where none of a few odd characters is in it.

        Cuts lie before a run of spaces, around a line feed and, in the fine way, before a mark; each only
        if no piece reaches over it.
        """
        long = [p for p in self.score if len(p) > 1]
        pairs = {p[i : i + 2] for p in long for i in range(len(p) - 1)}
        if any(x[0] != SPACE and x[1] == SPACE for x in pairs):
            return re.compile(".+", re.S), None, ""
        lone = "" if any("\n" in x for x in pairs) else "\n"
        feed = "\n|" if lone else ""
        found = {m for x in pairs for m in x if not m.isalnum()} - {SPACE, lone}
        marks, size = found, -1
        while len(marks) != size:
            size = len(marks)
            marks = {m for m in marks if len({x[0] for x in pairs if x[1] == m} - marks - {SPACE}) <= ODD}
        odd = "".join(sorted({x[0] for x in pairs if x[1] in marks} - marks - {SPACE}))
        marks = "".join(sorted(marks))
        body = f"[^{SPACE}{lone}{re.escape(marks)}]"
        fine = re.compile(f"{feed}{SPACE}+[{re.escape(marks)}]*{body}*|[{re.escape(marks)}]+{body}*|{body}+") if marks else None
        return re.compile(f"{feed}{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+"), fine, odd

    def _surface(self, i: int) -> str:
        """Bytes beyond ASCII stand as lone surrogates until a whole text is put together."""
        kind = self.kinds[i]
        if kind == BYTE:
            b = int(self.pieces[i][3:5], 16)
            return chr(b) if b < 128 else chr(0xDC00 + b)
        return "" if kind == CONTROL else self.unknown_surface if kind == UNKNOWN else self.pieces[i].replace(SPACE, " ")

    def merged(self, text: str) -> list[str]:
        """Split a short text by merging its characters; used to check neighbours."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins; None if merging does not lead to the piece."""
        parts = list(piece)
        while len(parts) > 2:
            found = [(self.rank[m], i) for i in range(len(parts) - 1) if (m := parts[i] + parts[i + 1]) in self.rank]
            if not found:
                return None
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _compatible(self, left: str, right: str) -> bool:
        """Whether the two, merged again, come back: no merge across their border comes before theirs.

        Their merges are taken back one by one, the latest first; what stands at the border then must not
        have a merge that is due earlier. Among equal ranks the left one is due first.
        """
        if not left or left[-1] + right[0] in self.tied:
            return self.merged(left + right) == ([left, right] if left else [right])
        rank, due = self.rank, 1 << 60
        if any(len(x) > 1 and not self.halves(x) for x in (left, right)):
            return False
        while True:
            if rank.get(left + right, due) < due:
                return False
            a, b = rank[left] if len(left) > 1 else -1, rank[right] if len(right) > 1 else -1
            if a < 0 and b < 0:
                return True
            if a > b:
                due, left = a, self.halves(left)[1]
            else:
                due, right = b + 1, self.halves(right)[0]

    def split(self, text: str) -> list[str]:
        """The pieces of a text; characters outside the model stand alone."""
        n = len(text)
        longest = [1] * n
        for last, size in self.automaton.iter(text):  # of two matches from one start the longer ends later
            longest[last - size + 1] = size
        failed = bytearray(n // 8 + 1)  # one bit for each position
        parts: list[str] = []
        shorter, known, left, at = self.shorter, self.known, "", 0
        size = longest[0] if n else 0
        while at < n:
            right_of = known[left]
            while size:
                end = at + size
                piece = text[at:end]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = right_of.get(piece)
                    if fits is None:
                        fits = self.compatible(left, piece)
                    if fits:
                        break
                size = shorter.get(piece, 0)
            if size:
                parts.append(piece)
                left, at = piece, end
                size = longest[at] if at < n else 0
            elif parts:
                failed[at >> 3] |= 1 << (at & 7)
                size = len(parts.pop())
                at -= size
                left = parts[-1] if parts else ""
            else:
                raise AssertionError("no split is compatible")
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """As _compatible, from a table of pairs that is emptied when full."""
        if self.n_known >= PAIR_ENTRIES:
            self.known.clear()
            self.n_known = 0
        self.n_known += 1
        found = self.known[left][right] = self._compatible(left, right)
        return found

    def _chunk_ids(self, chunk: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.split(chunk):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out += [self.byte_ids[b] for b in piece.encode("utf-8")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin or end id."""
        if not text:
            return []
        cache, out = self.cache, []
        cut = self.chunks if self.fine is None or any(x in text for x in self.odd) else self.fine
        for chunk in cut.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)):
            ids = cache.get(chunk)
            if ids is None:
                ids = self._chunk_ids(chunk)
                if len(chunk) <= CACHE_CHARS:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[chunk] = ids
            out += ids
        if not self.byte_fallback and out.count(self.unknown) > 1:  # neighbouring unknown characters are one
            out = [i for k, i in enumerate(out) if i != self.unknown or not k or out[k - 1] != i]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids are silent, the added first space goes, broken bytes become U+FFFD."""
        first = next((k for k, i in enumerate(ids) if self.kinds[i] != CONTROL), None)
        text = "".join(map(self.surface.__getitem__, ids))
        if self.dummy_prefix and first is not None and self.kinds[ids[first]] == NORMAL and self.pieces[ids[first]].startswith(SPACE):
            text = text[1:]
        try:
            text.encode("utf-8")
        except UnicodeEncodeError:
            raw = text.encode("utf-8", "surrogateescape")
            try:
                text = raw.decode("utf-8")
            except UnicodeDecodeError:
                text = raw.decode("utf-8", "surrogateescape")
                text = re.sub("[\udc80-\udcff]", "�", text)
        return text


_codecs: dict[str, Codec] = {}


def codec(model: bytes) -> Codec:
    """One codec for each model and process, so that tasks of a worker share its table."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _codecs:
        _codecs[key] = Codec(model)
    return _codecs[key]


def load_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", add_end: bool = True) -> DataFrame:
    """All columns of ``df`` with the ids of each whole text. Null and empty texts get the end id alone.

    A column of the name ``ids_col`` is replaced.
    """
    return _mapped(df, model_path, text_col, [(ids_col, "array<int>")], lambda c: lambda text: (_ids(c, text, add_end),))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` with the text of each list of ids. Null ids give an empty text."""
    return _mapped(df, model_path, ids_col, [(text_col, "string")], lambda c: lambda ids: (c.decode([] if ids is None else [int(i) for i in ids]),))


def _ids(c: Codec, text: str | None, add_end: bool = True) -> list[int]:
    ids = c.encode(text or "")
    return [*ids, c.end] if add_end else ids


def _digests(c: Codec):
    def of(text: str | None) -> tuple[int, str, str]:
        ids = _ids(c, text)
        written = " ".join(map(c.text_of.__getitem__, ids))
        return len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()

    return of


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _mapped(df: DataFrame, model_path: str, source: str, added: list[tuple[str, str]], make) -> DataFrame:
    """``df`` with columns computed row by row from one column, in batches on the executors."""
    model = load_model(model_path)  # the model's size does not depend on the data
    names = [n for n, _ in added]
    kept = [c for c in df.columns if c not in names]
    read = df if source in kept else df.withColumn("__source", df[source])
    source = source if source in kept else "__source"
    columns = [*kept] if source in kept else [*kept, source]

    kinds = [_ARROW[t] for _, t in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make(codec(model))
        for batch in batches:
            rows = [one(x) for x in batch.column(batch.schema.names.index(source)).to_pylist()]
            new = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            # The other columns pass as they are, whatever their types.
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(kept))], *new], [*kept, *names])

    fields = [f"`{n}` {df.schema[n].dataType.simpleString()}" for n in kept] + [f"`{n}` {t}" for n, t in added]
    return read.select(*[f"`{c}`" for c in columns]).mapInArrow(run, ", ".join(fields))


def encode_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, number of ids, and SHA-256 of the ids in decimal and of the decoded text.

    Each row stands alone: repeated rows give repeated results, an empty table an empty one.
    """
    slim = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))
    out = _mapped(slim, model_path, "text", [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")], _digests)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
