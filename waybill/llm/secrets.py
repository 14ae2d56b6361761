"""Secrets in texts: fixed forms, and strings of which a token of a public vocabulary holds few characters.

A byte-level BPE vocabulary spells ordinary words with few tokens, three to five characters each; random strings need
one for every character or two. Runs of key characters below a ratio are reported, unless they are digests or
identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import worker_store
from .words import slices

# The base forms, and the order of kinds.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS = 8, 16

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST_RUN = 20  # characters of RUN; letters of one case that are no word by their form alone
MOST_CHARS_PER_TOKEN = 2.0
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PART = re.compile(r"[A-Z]?[a-z]{3,}|(?<![A-Z0-9])[A-Z]{3,}(?![A-Z0-9])|(?<![A-Za-z0-9])[0-9]{4}(?![A-Za-z0-9])")
LETTERS = re.compile(r"[A-Za-z]{3,}")
BLOCK = 4096  # characters given to the vocabulary at a time


def vocabulary(path: str):
    """The tiktoken vocabulary in a file of ranks."""
    import public_tokenizers
    import tiktoken

    store = worker_store("vocabularies")
    if path not in store:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        store[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return store[path]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, in order; kinds count from 0."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def one_case(run: str) -> bool:
    """Letters of one case, and joints."""
    return (run.islower() or run.isupper()) and not any(c.isdigit() for c in run)


def is_known(run: str) -> bool:
    """Digests, numbers, and identifiers and paths: all but a fifth of their characters are in words, years and joints.

    Letters of one case look like words whatever they are: of LEAST_RUN or more nothing is known by their form.
    """
    if UUID.fullmatch(run) or DIGEST.fullmatch(run) and len(run) in DIGEST_LENGTHS or run.strip("+/_=-").isdigit():
        return True
    if not any(c.isalpha() for c in run):
        return True
    if one_case(run):
        return sum(map(len, LETTERS.findall(run))) < LEAST_RUN
    letters = sum(len(m) for m in PART.findall(run) if len(m) < LEAST_RUN)
    return letters + sum(c in "+/_=-" for c in run) >= 0.8 * len(run)


def random_spans(text: str, encoding) -> list[tuple[int, int, int]]:
    """(start, 3, end) of runs with few characters to a token; in runs of one case joints don't count."""
    spans = []
    for m in RUN.finditer(text):
        run = m.group()
        if is_known(run):
            continue
        parts = LETTERS.findall(run) if one_case(run) else [run]
        tokens = sum(len(encoding.encode_ordinary(p[i : i + BLOCK])) for p in parts for i in range(0, len(p), BLOCK))
        if sum(map(len, parts)) < MOST_CHARS_PER_TOKEN * tokens:
            spans.append((m.start(), 3, m.end()))
    return spans


def scan_text(text: str, encoding) -> tuple[list, list]:
    """Base spans, and those with the random ones that overlap none of them, both in order."""
    base = base_spans(text)
    apart, at, reached = [], 0, 0
    for span in random_spans(text, encoding):  # both are in order: one pass over the two
        while at < len(base) and base[at][0] < span[2]:
            reached = max(reached, base[at][2])
            at += 1
        if reached <= span[0]:
            apart.append(span)
    return base, sorted(base + apart)


def spelled(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scan(path: str):
    def read(batches):
        encoding = vocabulary(path)
        for batch in slices(batches):
            rows = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for text in batch.column(1):
                base, spans = scan_text(text.as_py() or "", encoding)
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    rows[name].append(sum(s[1] == kind for s in base))
                rows["base_sha256"].append(hashlib.sha256(spelled(base).encode()).hexdigest())
                rows["spans"].append(spelled(spans))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            columns = [pa.array(v, k) for v, k in zip(rows.values(), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *rows])

    return read


def secret_spans(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base forms, a hash of their spans, and all spans (code points, end exclusive) for every row.

    Null texts are empty: no spans, and the hash of the empty string. Of random runs those that touch a base span are
    not named again. Rows with null or repeated ids are each scanned; other columns are ignored; an empty table gives
    an empty result. The vocabulary file is read on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(_scan(vocabulary_path), schema).withColumnRenamed("id", id_col)
