"""Secrets by three fixed patterns, and by novelty to a primed compressor.

Beyond the patterns, a *novel* span is a run of key characters, with or without digits, that stands within CONTEXT
characters of a sensitive word, before or after it, or holds one, and that Zstandard, primed with a dictionary of
identifiers and ordinary code and with the text around it, cannot shrink: the bytes that it adds to the compressed
context are at least NOVELTY of its length, and at least ADDED (a shorter run cannot add as many). Identifiers and paths cost next to
nothing and are not reported. A string's own copies are cut out of its surroundings first, so that each place of a
secret that stands there twice is reported.

Defined results: null and empty texts have no span; spans count code points, the end exclusive; repeated rows give
repeated results; an empty table gives no rows. The plan has no shuffle, and a text is read whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the query's contract, with the least length of what they must hold.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

CONTEXT = 160
#: Least share of its length, and least number of bytes, that a novel span adds.
NOVELTY, ADDED = 0.6, 10
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+")
TRAILING = re.compile(r"[A-Za-z0-9+/_=-]+\Z")
SENSITIVE = re.compile(r"(?ai:secret|token|passw|credential|api_?key|private|bearer|authori[sz]ation|access)")
DICTIONARY = """
import from return function class public private static void const let var def self this new null true false none
string integer boolean float double array object list dict value values key keys index name type data result response
request session user username password passwd secret token access_token refresh_token client_id client_secret api_key
apikey authorization bearer credentials config settings environment process.env os.environ getenv export default host
port database connection url https://www.example.com/ http://localhost:8080/api/v1/users application/json utf-8
content-type accept encoding base64 sha256 sha1 md5 hash digest signature certificate BEGIN RSA PRIVATE KEY END PUBLIC
github gitlab aws_access_key_id aws_secret_access_key region us-east-1 bucket storage account subscription tenant
""".strip()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns; kinds 0 to 2 as they are listed."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def apart(word: str, before: str, behind: str) -> str:
    """The surroundings without the string's own copies, also those that the window cuts: a secret that stands twice is still one."""
    before, behind = before.replace(word, " "), behind.replace(word, " ")
    first, last = CANDIDATE.match(before), TRAILING.search(behind)
    if first and word.endswith(first.group()):
        before = before[first.end() :]
    if last and word.startswith(last.group()):
        behind = behind[: last.start()]
    return before + behind


class Novelty:
    """Marginal compressed size against a dictionary and the text around a candidate."""

    def __init__(self, words: str = DICTIONARY, level: int = 9) -> None:
        import zstandard

        primed = zstandard.ZstdCompressionDict(words.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_dict_id=False).compress

    def added(self, around: str, candidate: str) -> int:
        """Bytes that the candidate adds, its length at most; random base64 digits need 0.75 of their length."""
        if len(candidate) < ADDED:  # cannot add as much, so it need not be measured
            return len(candidate)
        plain = around.encode("utf-8", "surrogatepass")
        return min(len(candidate), len(self.compress(plain + candidate.encode())) - len(self.compress(plain)))

    def spans(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        out, near = [], [m.span() for m in SENSITIVE.finditer(text)]
        if not near:
            return out
        taken, at, passed = sorted((a, b) for a, _, b in base), 0, 0
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            while at < len(near) and near[at][1] < start - CONTEXT:
                at += 1
            if at == len(near):
                break
            if near[at][0] > end + CONTEXT:
                continue
            word = m.group()
            while passed < len(taken) and taken[passed][1] <= start:
                passed += 1
            if passed < len(taken) and taken[passed][0] < end:
                continue
            around = apart(word, text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT])
            if self.added(around, word) >= max(ADDED, NOVELTY * len(word)):
                out.append((start, 3, end))
        return out


KINDS = ("assign", "access", "hex", "novel")


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256 and spans of every row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
    types = [pa.int64()] * 5 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py() or ""
                base = base_spans(text)
                every = sorted(base + novelty.spans(text, base))
                counts = [sum(kind == k for _, kind, _ in every) for k in range(4)]
                rows.append((doc, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
    )
