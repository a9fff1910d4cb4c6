"""Encoding by a SentencePiece merge model through a table of prefixes, and decoding.

Merging joins the two neighbours whose union is the best piece, the leftmost first, until no union
is a piece. Whether a token borders another in the result depends on these two alone: a merge
across their border would happen in their own union too. So a sequence is the encoding of its
text if each pair of neighbours is the encoding of its union, and a prefix's last token is the
one match ending there that is compatible with the last token of the prefix before it. Matches
come from one automaton over all pieces; the ids follow from the last tokens, read backwards.

A border between two characters that are neighbours in no piece stays whatever stands around
it. Before a blank, and between letters and signs, this is so in the usual models, so the table
is filled run by run, and each worker remembers the runs that it has met.
"""

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as proto

#: The mark that stands for a blank.
MARK = "▁"
#: Runs and pairs of tokens that a worker remembers; both only save time. Of runs the older half gives way.
REMEMBERED = 1_000_000
#: Longer runs are encoded each time.
LONGEST = 64
#: With more borders than this that letters and signs share in pieces, only blanks cut.
SHARED = 200
#: Rows that one batch hands on.
BATCH_ROWS = 2_000


class Model:
    """Pieces of a model file, its automaton and what is known about words and pairs."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto.FromString(self.processor.serialized_model_proto())
        rules, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece.Type
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{path} is no merge model with byte fallback")
        if (rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError(f"{path} changes texts before it encodes them")
        if any(p.type in (kinds.Value("USER_DEFINED"), kinds.Value("UNUSED")) for p in model.pieces):
            raise ValueError(f"{path} has pieces of its user, or unused ones")
        self.prefix = MARK if rules.add_dummy_prefix else ""
        normal = [(k, p) for k, p in enumerate(model.pieces) if p.type == kinds.Value("NORMAL")]
        self.id = {p.piece: k for k, p in normal}
        self.score = {p.piece: p.score for k, p in normal}
        self.bytes = {int(p.piece[3:5], 16): k for k, p in enumerate(model.pieces) if p.type == kinds.Value("BYTE")}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.runs = re.compile(self._run())
        self.after: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.single: dict[str, bool] = {}
        self.known: dict[str, tuple[list[int], str]] = {}
        self.older: dict[str, tuple[list[int], str]] = {}

    def _run(self) -> str:
        """A pattern whose matches cover a text and end only at borders that no piece holds."""
        if any(MARK in p.lstrip(MARK) for p in self.id):
            return "(?s:.+)"
        letter, sign = r"[^\W_]", rf"(?:_|[^\w{MARK}])"
        kind = re.compile(letter)
        shared = {a + b for p in self.id for a, b in zip(p, p[1:]) if MARK not in a + b and bool(kind.match(a)) != bool(kind.match(b))}
        if len(shared) > SHARED:
            return f"{MARK}*[^{MARK}]+|{MARK}+"
        held = "|".join(f"(?<={re.escape(x[0])})(?={re.escape(x[1])})" for x in sorted(shared))
        more = f"(?:(?:{held})(?:{letter}+|{sign}+))*" if held else ""
        return f"{MARK}*(?:{letter}+|{sign}+){more}|{MARK}+"

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by merging, for the test of pairs."""
        parts = list(text)
        score = self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens are the encoding of their union."""
        found = self.after.setdefault(left, {}).get(right)
        if found is None:
            union = left + right
            found = union not in self.id and self.merged(union) == [left, right]
            self.n_pairs += 1
            if self.n_pairs > REMEMBERED:
                self.after, self.n_pairs = {left: {}}, 1
            self.after[left][right] = found
        return found

    def alone(self, token: str) -> bool:
        """Whether a piece is the encoding of itself."""
        found = self.single.get(token)
        if found is None:
            found = self.single[token] = self.merged(token) == [token]
        return found

    def last_tokens(self, text: str) -> list[str]:
        """For each prefix of 1, 2, ... characters the last token of its encoding."""
        last: list[str] = []
        after, compatible, alone = self.after, self.compatible, self.alone
        for end, token in self.automaton.iter(text):  # by end; at one end the longest first
            n = len(last)
            if end < n:
                continue
            while n < end:  # a character without a piece is a token by itself
                last.append(text[n])
                n += 1
            begin = end - len(token)
            if begin < 0:
                fits = alone(token)
            else:
                left = last[begin]
                known = after.get(left)
                fits = known.get(token) if known is not None else None
                if fits is None:
                    fits = compatible(left, token)
            if fits:
                last.append(token)
        last.extend(text[len(last):])
        return last

    def tokens(self, text: str) -> list[str]:
        last = self.last_tokens(text)
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(last[at - 1])
        return out[::-1]

    def _own(self, run: str) -> tuple[list[int], str]:
        found = self.known.get(run) or self.older.get(run)
        if found is None:
            ids: list[int] = []
            for token in self.tokens(run):
                own = self.id.get(token)
                ids.extend([self.bytes[b] for b in token.encode()] if own is None else [own])
            found = ids, ",".join(map(str, ids))
        if len(run) <= LONGEST:
            if len(self.known) >= REMEMBERED // 2:
                self.known, self.older = {}, self.known
            self.known[run] = found
        return found

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids of a whole text, and their digits joined by commas."""
        if not text:
            return [], ""
        known, own = self.known.get, self._own
        out = [known(run) or own(run) for run in self.runs.findall(self.prefix + text.replace(" ", MARK))]
        return list(chain.from_iterable([ids for ids, _ in out])), ",".join([digits for _, digits in out])

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


_models: dict[str, Model] = {}


def _encode(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _models.get(path) or _models.setdefault(path, Model(path))
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(begin, BATCH_ROWS)
                out: list[list] = [[] for _ in range(4)]
                for raw in part.column(1):
                    ids, digits = model.encode((raw.as_py() or b"").decode("utf-8", "replace"))
                    text = model.decode(ids).encode()
                    own = (len(ids), hashlib.sha256(digits.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), ids if with_ids else None)
                    for column, x in zip(out, own):
                        column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                     pa.array(out[3], pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    return run


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every whole text, as the library of the model encodes it.

    ``model`` is a file that every executor sees at this path. ids_sha256 is the digest of the
    decimal ids joined by commas, decoded_sha256 that of the text that the ids give. A null
    is an empty text, which has no ids; repeated rows and null ids stay as they are; an empty table
    gives none. Time grows with the length of a text, memory too: one text is held at once.
    Other columns of docs are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    out = rows.mapInArrow(_encode(model, with_ids), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")
    return out if with_ids else out.drop("ids")
