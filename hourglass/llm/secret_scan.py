"""Secret scans: fixed patterns, and Markov models of random strings.

The patterns find assignments, access keys and long hexadecimal runs. Besides them, each
run of 16 or more key characters, or what patterns' spans leave of it (8 or more), is scored
by the log-likelihood ratio, per character, of two character Markov models: one of random
strings, one of ordinary identifiers. Parts with a letter above the threshold become spans of
kind ``random``; in others, so do the best-scoring stretches of 16 or more characters (8 or
more beside a pattern's span) that are above it by more than the choice among the part's
stretches explains. A stretch is widened to the next ``/``, ``_``, ``-`` or ``+`` and scored
again: the widened one counts if it is above the threshold still, else the stretch itself if
it has a digit and is above ``STRICT``, else none.

The models are trained from labelled samples: identifiers and paths made of ordinary words of
four languages, random strings from a seeded generator, and runs of key characters of a sample
of documents, labelled as secret where a pattern matches and as ordinary elsewhere
(counted in the tasks, only the counts of character pairs are gathered). Made identifiers and
the documents' runs weigh the same, so neither drowns the other.

Defined results: a null text is an empty one (no spans); null ids, repeated rows and other
columns are kept as they are; texts of any length are scanned whole; without documents
the models rest on the generated strings and smoothing alone.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.shared_files import ship_package

# The base patterns and least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")
HEX_LEAST = 24
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

#: Characters of keys; every hexadecimal run lies in a run of these.
KEY_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
KEY_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
WORD_RUN = re.compile(r"[A-Za-z0-9+/_-]{3,}")
LETTER = re.compile(r"[A-Za-z]")
DIGIT = re.compile(r"[0-9]")
RUN_LEAST, PART_LEAST = 16, 8
SEPARATORS = "/_-+"
#: Least log-likelihood ratio, in nats a character.
THRESHOLD = 0.5
#: The same for a stretch whose surroundings are ordinary.
STRICT = 1.0
#: About how many documents the ordinary model is trained on.
SAMPLE_DOCUMENTS = 2000
#: Generated random strings for each alphabet.
GENERATED = 2000
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             KEY_CHARS[:62], KEY_CHARS[:64], KEY_CHARS[:62] + "-_")

# Ordinary words that the labelled identifiers are made of.
ORDINARY_WORDS = """
access account action address agent amount application archive array article attribute author average backup balance
batch block branch browser budget button cache calendar callback category channel character charge client cluster code column
command company component config connection content context control counter country create current customer database date
default delete delivery description device document download driver duplicate element employee encoding engine entry error
event example export factory feature field filter folder format function gateway group handler header height history image
import index information input instance interface internal invoice item kernel label language layer length library license
list location logger manager memory message method model module monitor network node notification number object operation
option order output package parameter parser password payment person platform position process product profile project
property provider query queue random record reference region register release report request resource response result
compte fichier utilisateur adresse nombre valeur recherche liste facture livraison
benutzer gesellschaft verwaltung rechnung auftrag schluessel einstellung datei zeichen uebersicht
usuario cliente archivo nombre direccion pedido factura busqueda cuenta servicio
""".split()
#: Made identifiers.
IDENTIFIERS = 12_000
#: Character pairs that each ordinary sample weighs.
WEIGHT = 300_000

_CODE = {c: i for i, c in enumerate(KEY_CHARS)}
_START = len(KEY_CHARS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each pattern that are long enough, in code points."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_LEAST]
    for run in KEY_RUN.finditer(text):
        if run.end() - run.start() >= HEX_LEAST:
            found += [(*m.span(), "hex") for m in HEX.finditer(text, *run.span())]
    return found


def _outside(spans: list[tuple[int, int, str]], start: int, end: int) -> bool:
    return all(end <= s or start >= e for s, e, _ in spans)


def pairs(run: str) -> list[int]:
    """Cells of the transition table that a run of key characters takes."""
    codes = [_START, *(_CODE[c] for c in run)]
    return [a * _START + b for a, b in zip(codes, codes[1:], strict=False)]


def transition_logs(counts: np.ndarray, smoothing: float = 0.5) -> np.ndarray:
    table = counts.reshape(_START + 1, _START) + smoothing
    return np.log(table / table.sum(1, keepdims=True))


def generated_counts(seed: int = 7) -> np.ndarray:
    own, counts = random.Random(seed), np.zeros((_START + 1) * _START)
    for alphabet in ALPHABETS:
        for _ in range(GENERATED):
            np.add.at(counts, pairs("".join(own.choices(alphabet, k=own.randint(16, 48)))), 1)
    return counts


def identifiers(n: int = IDENTIFIERS, seed: int = 5, words: list[str] = ORDINARY_WORDS) -> list[str]:
    """Ordinary identifiers: words joined by one sign, in camel case or as one, and paths of them."""
    own = random.Random(seed)

    def name() -> str:
        parts, style = own.choices(words, k=own.randint(1, 4)), own.randrange(6)
        if style == 0:
            text = "".join(w.capitalize() for w in parts)
        elif style == 1:
            text = parts[0] + "".join(w.capitalize() for w in parts[1:])
        elif style == 2:
            text = "".join(parts)
        elif style == 3:
            text = "_".join(parts).upper()
        else:
            text = "_-"[style - 4].join(parts)
        return text + (own.choice(["", "_", "-"]) + str(own.randint(0, 10 ** own.randint(1, 4))) if own.random() < 0.25 else "")

    return ["/".join(name() for _ in range(own.choice((1, 1, 1, 2, 4)))) for _ in range(n)]


def train(samples: list[tuple[str, bool]] | None = None, secret: np.ndarray | None = None,
          ordinary: np.ndarray | None = None) -> list[float]:
    """The log ratio of each transition, from labelled runs or their pair counts."""
    size = (_START + 1) * _START
    made = np.zeros(size)
    for run in identifiers():
        np.add.at(made, pairs(run), 1)
    seen = {True: np.zeros(size) if secret is None else secret.astype(float),
            False: np.zeros(size) if ordinary is None else ordinary.astype(float)}
    for run, label in samples or ():
        np.add.at(seen[label], pairs(run), 1)
    weighed = lambda t: t * (WEIGHT / max(t.sum(), WEIGHT))
    tables = {True: generated_counts() + seen[True], False: weighed(made) + weighed(seen[False])}
    return (transition_logs(tables[True]) - transition_logs(tables[False])).ravel().tolist()


def train_on(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> list[float]:
    """Train on about ``sample_documents`` documents, chosen by the hash of their id, and every
    row of a table that is no larger. Rows of one id are chosen together; tasks add up their own."""
    ship_package(docs.sparkSession)
    every = max(1, docs.count() // sample_documents)
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {label: np.zeros((_START + 1) * _START, np.int64) for label in (True, False)}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                for run in WORD_RUN.finditer(text or ""):
                    np.add.at(tables[not _outside(spans, *run.span())], pairs(run[0]), 1)
        for label, table in tables.items():
            cells = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict({"secret": pa.array([label] * len(cells), pa.bool_()),
                                              "cell": pa.array(cells, pa.int32()),
                                              "n": pa.array(table[cells], pa.int64())})

    gathered = {label: np.zeros((_START + 1) * _START) for label in (True, False)}
    # At most one row for each label and character pair.
    for row in (some.mapInArrow(count, "secret boolean, cell int, n long")
                .groupBy("secret", "cell").agg(F.sum("n").alias("n")).collect()):
        gathered[row.secret][row.cell] = row.n
    return train(secret=gathered[True], ordinary=gathered[False])


def _left(spans: list[tuple[int, int, str]], start: int, end: int) -> Iterator[tuple[int, int]]:
    """What the spans leave of start to end."""
    for s, e, _ in sorted(spans):
        if e > start and s < end:
            if s > start:
                yield start, s
            start = max(start, e)
    if start < end:
        yield start, end


def random_parts(run: str, ratio: list[float], threshold: float, least: int) -> Iterator[tuple[int, int, float]]:
    """(start, end, score) of the run, if its score is above the threshold, or of its best stretches."""
    if len(run) < least:
        return
    each = [ratio[k] for k in pairs(run)]
    score = sum(each) / len(run)
    if score >= threshold:
        yield 0, len(run), score
        return
    sums = [0.0]                     # of what exceeds the threshold
    for x in each:
        sums.append(sums[-1] + x - threshold)
    # A stretch ends where the sum has fallen from its peak by more than chance explains.
    chance, start, end = 2 * math.log(len(run)), 0, len(run)
    low, gain, a, b, j = 0, chance, 0, 0, least
    while j <= end:
        if sums[j - least] < sums[low]:
            low = j - least
        if sums[j] - sums[low] > gain:
            gain, a, b = sums[j] - sums[low], low, j
        j += 1
        if b and (j > end or sums[b] - sums[j] > chance):
            a, b = a + (run[a] == "/"), b - (run[b - 1] == "/")
            wide_a, wide_b = a, b
            while wide_a > start and run[wide_a - 1] not in SEPARATORS:
                wide_a -= 1
            while wide_b < end and run[wide_b] not in SEPARATORS:
                wide_b += 1
            mean = lambda x, y: sum(each[x:y]) / max(y - x, 1)
            if mean(wide_a, wide_b) >= threshold:
                a, b = wide_a, wide_b
            elif mean(a, b) < max(STRICT, threshold) or not DIGIT.search(run, a, b):
                a = b
            if LETTER.search(run, a, b):
                yield a, b, mean(a, b)
            start = low = b
            gain, b, j = chance, 0, b + least


def all_spans(text: str, ratio: list[float], threshold: float = THRESHOLD) -> list[tuple[int, int, str, float | None]]:
    """Base spans and random runs, by start and then by kind."""
    base = base_spans(text)
    found = [(s, e, kind, None) for s, e, kind in base]
    for run in KEY_RUN.finditer(text):
        whole = not base or _outside(base, *run.span())
        for start, end in [run.span()] if whole else _left(base, *run.span()):
            if LETTER.search(text, start, end):
                found += [(start + a, start + b, "random", score) for a, b, score in
                          random_parts(text[start:end], ratio, threshold, RUN_LEAST if whole else PART_LEAST)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                   ("end", pa.int32()), ("score", pa.float64())]))


def find_secrets(docs: DataFrame, ratio: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) of ``docs`` (doc_id, text); places are code points, end exclusive."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e, "score": x}
                      for s, e, k, x in all_spans(t or "", ratio, threshold)]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, _SPANS_ARROW)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, f"doc_id long, spans {SPANS}")


def mask_secrets(docs: DataFrame, ratio: list[float], mask: str = "[secret]",
                 threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span's text replaced by ``mask``; rows and columns stay."""
    ship_package(docs.sparkSession)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, end, _, _ in all_spans(text, ratio, threshold):
            if end <= at:
                continue
            if start >= at:      # spans that overlap get one mask
                out += [text[at:start], mask]
            at = end
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = pa.array([clean(t) for t in batch.column(k).to_pylist()], pa.string())
            columns = batch.columns
            columns[k] = pc.cast(texts, batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
