"""Secrets in texts: known formats, and strings that a battery of randomness tests can't tell from random ones.

Long unbroken strings get an inferred encoding and three tests against randomness: chi-squared
uniformity over its alphabet, a runs test over kinds of characters and a serial correlation. Their
joint p-value is compared with that of ordinary prose of the same length, all of every
document, and a false-discovery rate is controlled within every class of lengths.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eigenlake.llm.staging import Staging
from eigenlake.llm.text import bytes_of, string_parts

# Kinds in their order, the formats searched for and the characters each match needs.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN_CHARS = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_CHARS = 16
HEX_CHARS = 32

# Shortest string of each length class; shorter ones carry too little evidence.
CLASSES = (20, 24, 32, 48, 64, 128)
# Bins of -log10 of the joint p-value, and the largest value that still counts as random.
BIN, BINS, LARGEST = 0.05, 400, 2.0
# Windows of prose that are tested in one step.
WINDOW_STEP = 1 << 13

_HEX = np.isin(np.arange(256), list(b"0123456789abcdef"))
_TOKEN = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"))
_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_KIND = np.array([0 if 97 <= c < 123 else 1 if 65 <= c < 91 else 2 if 48 <= c < 58 else 3 for c in range(256)], np.int8)
ALPHABETS = tuple(
    bytes(alphabet, "ascii")
    for alphabet in (
        "0123456789",
        "0123456789abcdef",
        "0123456789ABCDEF",
        "abcdefghijklmnopqrstuvwxyz",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
        "abcdefghijklmnopqrstuvwxyz0123456789",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
    )
)


def _normal_tail(z: float) -> float:
    return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)


def disorder(text: bytes) -> float:
    """-log10 of the joint p-value of the three tests against randomness; small for random strings."""
    text = text.rstrip(b"=") or text
    used = set(text)
    alphabet = next(a for a in ALPHABETS if used <= set(a))
    place = np.zeros(256, np.int64)
    place[list(alphabet)] = np.arange(len(alphabet))
    raw = np.frombuffer(text, np.uint8)
    x, n, k = place[raw], len(text), len(alphabet)
    counts = np.bincount(x, minlength=k)
    chi = float((counts.astype(float) ** 2).sum()) * k / n - n
    p_chi = _normal_tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    kinds = _KIND[raw]
    if (kinds == kinds[0]).all():
        kinds = (2 * x >= k).astype(np.int8)
    groups = np.bincount(kinds).astype(float)
    runs = 1 + int((kinds[1:] != kinds[:-1]).sum())
    squares = float((groups**2).sum())
    mean = n + 1 - squares / n
    variance = (squares * (squares + n * (n + 1)) - 2 * n * float((groups**3).sum()) - n**3) / (n * n * (n - 1))
    p_runs = 2 * _normal_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 1e-9 else 1e-6
    centred = x - x.mean()
    power = float((centred * centred).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    p_serial = 2 * _normal_tail(abs(serial + 1 / n) * math.sqrt(n))
    joint = -sum(math.log(min(1.0, p)) for p in (p_chi, p_runs, p_serial))
    # Fisher's method: chi-squared with six degrees of freedom has a closed tail.
    return (joint - math.log1p(joint + joint * joint / 2)) / math.log(10)


# Which alphabets hold a byte, one bit each, and the place of a byte in each.
_IN = np.array([sum((c in a) << i for i, a in enumerate(ALPHABETS)) for c in range(256)], np.uint16)
_PLACE = np.zeros((len(ALPHABETS), 256), np.int32)
for _i, _alphabet in enumerate(ALPHABETS):
    _PLACE[_i, list(_alphabet)] = np.arange(len(_alphabet))


# -ln of the normal tail at points so close that lines between them err by less than 1e-8.
_TAIL_STEP, _TAIL_LOW, _TAIL_HIGH = 2.0**-12, -12.0, 40.0


@functools.cache
def _tail_table() -> np.ndarray:
    points = np.arange(_TAIL_LOW, _TAIL_HIGH + 2 * _TAIL_STEP, _TAIL_STEP)
    return np.array([-math.log(_normal_tail(z)) for z in points.tolist()])


def _log_tails(z: np.ndarray, sides: int) -> np.ndarray:
    """-ln of the one- or two-sided tail, at least 0."""
    table = _tail_table()
    at = (np.clip(z, _TAIL_LOW, _TAIL_HIGH) - _TAIL_LOW) / _TAIL_STEP
    left = at.astype(np.int64)
    value = table[left] + (table[left + 1] - table[left]) * (at - left)
    return np.maximum(value - math.log(sides), 0.0)


def disorders(windows: np.ndarray) -> np.ndarray:
    """``disorder`` of every row of bytes, none of which ends with an equals sign."""
    out, n = np.zeros(len(windows)), windows.shape[1]
    common = np.bitwise_and.reduce(_IN[windows], axis=1).astype(np.int64)
    first = np.log2(common & -common).astype(np.int64)
    for number in np.unique(first).tolist():
        rows = np.flatnonzero(first == number)
        raw, k = windows[rows], len(ALPHABETS[number])
        x, m = _PLACE[number][raw], len(rows)
        counts = np.bincount((x + np.arange(0, k * m, k, dtype=np.int32)[:, None]).ravel(), minlength=k * m).reshape(m, k)
        chi = np.einsum("ij,ij->i", counts, counts) * k / n - n
        joint = _log_tails((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n), 1)
        kinds = _KIND[raw]
        same = (kinds == kinds[:, :1]).all(axis=1)
        kinds[same] = 2 * x[same] >= k
        groups = np.stack([np.count_nonzero(kinds == j, axis=1) for j in range(int(kinds.max()) + 1)]).astype(float)
        runs = 1 + np.count_nonzero(kinds[:, 1:] != kinds[:, :-1], axis=1)
        squares = (groups**2).sum(axis=0)
        mean = n + 1 - squares / n
        variance = (squares * (squares + n * (n + 1)) - 2 * n * (groups**3).sum(axis=0) - n**3) / (n * n * (n - 1))
        varied = variance > 1e-9
        apart = np.divide(np.abs(runs - mean), np.sqrt(variance, where=varied, out=np.ones(m)))
        joint += np.where(varied, _log_tails(apart, 2), -math.log(1e-6))
        # Moments of small integers are exact.
        total = x.sum(axis=1)
        centre = total / n
        power = np.einsum("ij,ij->i", x, x) - total * centre
        lagged = np.einsum("ij,ij->i", x[:, 1:], x[:, :-1]) - centre * (2 * total - x[:, 0] - x[:, -1]) + (n - 1) * centre * centre
        serial = np.divide(lagged, power, out=np.ones(m), where=power > 1e-9)
        joint += _log_tails(np.abs(serial + 1 / n) * math.sqrt(n), 2)
        out[rows] = (joint - np.log1p(joint + joint * joint / 2)) / math.log(10)
    return out


def ungrouped(text: bytes) -> bytes:
    """Hex digits without the dashes that only group them, as in a UUID; any other text as it is."""
    plain = text.replace(b"-", b"")
    return plain if len(plain) < len(text) and any(set(plain) <= set(a) for a in ALPHABETS[:3]) else text


def length_class(length: int) -> int:
    return sum(length >= bound for bound in CLASSES) - 1


def _bin(value: float) -> int:
    return min(BINS - 1, int(value / BIN))


def long_runs(inside: np.ndarray, rows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of the maximal runs of true cells; a run ends with its row."""
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    bounds = np.unique(np.concatenate([change, rows]))
    start, end = bounds[:-1], bounds[1:]
    wanted = inside[start] & (end - start >= least) if len(start) else np.zeros(0, bool)
    start, end = start[wanted], end[wanted]
    return np.searchsorted(rows, start, "right") - 1, start, end


def format_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the assignments and access keys of a text, in code points."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    return found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
CANDIDATES = pa.list_(
    pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("class", pa.int32()), ("bin", pa.int32())])
)


def _scan(part: pa.Array) -> tuple[list, list, np.ndarray]:
    """Format spans and candidates of every text; windows of prose per length class and bin of all."""
    data, rows = bytes_of(part)
    base: list[list] = [[] for _ in range(len(part))]
    strings: list[list] = [[] for _ in range(len(part))]
    raw = [data[rows[i] : rows[i + 1]].tobytes() for i in range(len(part))]
    for i, text in enumerate(raw):
        if text:
            base[i] = format_spans(text.decode())
    for row, start, end in zip(*long_runs(_HEX[data], rows, HEX_CHARS), strict=True):
        a = len(raw[row][: start - rows[row]].decode())
        base[row].append((a, 2, a + int(end - start)))
    letters = _LETTER[data]
    for row, start, end in zip(*long_runs(_TOKEN[data], rows, CLASSES[0]), strict=True):
        # What may be a secret is no prose.
        letters[start:end] = False
        a, length = len(raw[row][: start - rows[row]].decode()), int(end - start)
        string = ungrouped(data[start:end].tobytes())
        if len(string) >= CLASSES[0] and not any(s < a + length and a < e for s, _, e in base[row]):
            strings[row].append((a, 3, a + length, length_class(len(string)), _bin(disorder(string))))
    # Letters of each text without what separates them, cut into windows of every length from its beginning.
    prose = np.zeros((len(CLASSES), BINS), np.int64)
    cells = data[letters]
    first = np.concatenate([[0], np.cumsum(letters)])[rows]
    for number, length in enumerate(CLASSES):
        count = np.diff(first) // length
        begin = np.repeat(first[:-1] - length * (np.cumsum(count) - count), count) + length * np.arange(count.sum())
        for at in range(0, len(begin), WINDOW_STEP):
            values = disorders(cells[begin[at : at + WINDOW_STEP, None] + np.arange(length)])
            prose[number] += np.bincount(np.minimum(BINS - 1, (values / BIN).astype(np.int64)), minlength=BINS)
    return [sorted(b) for b in base], strings, prose


PROSE = pa.list_(pa.struct([("class", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))


def scan_texts(docs: DataFrame) -> DataFrame:
    """Spans and candidates per row; ``prose`` of the first row of a piece counts the windows of the whole piece."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part in string_parts(batch.column(1)):
                base, strings, prose = _scan(part)
                windows = [{"class": c, "bin": b, "n": prose[c, b]} for c, b in np.argwhere(prose).tolist()]
                as_rows = [[dict(zip(("start", "kind", "end"), s, strict=True)) for s in b] for b in base]
                names = ("start", "kind", "end", "class", "bin")
                counts = [[sum(s[1] == number for s in b) for b in base] for number in range(3)]
                digests = [hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest() for b in base]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(part)),
                        *[pa.array(c, pa.int64()) for c in counts],
                        pa.array(digests),
                        pa.array(as_rows, SPANS),
                        pa.array([[dict(zip(names, s, strict=True)) for s in b] for b in strings], CANDIDATES),
                        pa.array([windows, *[None] * (len(part) - 1)], PROSE),
                    ],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "strings", "prose"],
                )
                row += len(part)

    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string,"
    schema += " base array<struct<start:long,kind:int,end:long>>,"
    schema += " strings array<struct<start:long,kind:int,end:long,class:int,bin:int>>,"
    schema += " prose array<struct<class:int,bin:int,n:long>>"
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, schema)


def discovery_bounds(strings: np.ndarray, prose: np.ndarray, rate: float) -> list[int]:
    """Last bin accepted in every length class (-1: none): Benjamini-Hochberg over counts per bin."""
    bounds = []
    for found, null in zip(strings.cumsum(axis=1), prose.cumsum(axis=1), strict=True):
        p = (1 + null) / (1 + null[-1])
        good = np.flatnonzero((found[-1] * p <= rate * found) & (found > 0))
        last = int(good[-1]) if len(good) else -1
        bounds.append(min(last, int(LARGEST / BIN) - 1))
    return bounds


def find_secrets(docs: DataFrame, rate: float = 0.01) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans`` for every row of ``docs(doc_id, text, ...)``.

    Spans are ``kind:start:end`` of whole matches in code points, by start, then kind; ``base_sha256`` is
    over those of the fixed formats. Random strings that touch a span of a fixed format are not
    added. A null text is empty: no spans, the digest of nothing. Repeated rows are scanned each; other columns are not read.
    ``rate`` is the share of false discoveries among random strings aimed at in each length class.
    """
    staging = Staging(docs.sparkSession, "secrets")
    found = staging.keep(scan_texts(docs), "scanned")
    strings = found.select(F.explode("strings").alias("s")).select(F.lit(0).alias("what"), "s.class", "s.bin", F.lit(1).cast("long").alias("n"))
    prose = found.select(F.explode("prose").alias("s")).select(F.lit(1), "s.class", "s.bin", "s.n")
    counts = np.zeros((2, len(CLASSES), BINS), np.int64)
    # At most 2 x classes x bins rows, whatever the input.
    for what, number, bin_, n in strings.union(prose).groupBy("what", "class", "bin").agg(F.sum("n")).collect():
        counts[what, number, bin_] = n
    bounds = F.array(*[F.lit(b) for b in discovery_bounds(counts[0], counts[1], rate)])
    random = F.filter("strings", lambda s: s["bin"] <= F.element_at(bounds, s["class"] + 1))
    narrow = F.transform(random, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    names = F.array(*[F.lit(k) for k in KINDS])
    written = F.transform(
        F.array_sort(F.concat("base", narrow)),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size(random).cast("long").alias("n_random"), "base_sha256",
        F.array_join(written, ",").alias("spans"),
    )
