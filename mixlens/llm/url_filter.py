"""URL filters: a bit-parallel wildcard automaton (multiword Shift-And).

Method. A rule (host, path) is the glob ``*.host`` + ``path*`` over the canonical URL ``.`` + host +
path, where the first star stays within the host. All rules lie end to end in one bit string;
a byte moves every rule's state on at once: ``D = ((D << 1) | starts) & match[byte] | D &
stay[byte]``, where ``stay`` holds the stars. The states of a batch of URLs are the rows of one
array of 64-bit words, so each step moves all URLs of the batch by one byte.

Of the rules that fit, the longest text wins; of equally long ones a block rule, then the
smaller text. No rule: ``default``.

Cases: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path is what follows up to ``?``, ``#`` or the end. NULL or no ``://``: both are empty, and no rule
fits. Repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value

by_value(__name__)

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
HOST, PATH = r"://([^/?#]*)", r"://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Automaton:
    """Masks of all rules: one bit for the state before each symbol, one for acceptance."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]) -> None:
        self.rules = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
        starts, ends, at = [], [], 0
        symbols = []
        for _, host, path in self.rules:
            text = ("." + host + path).encode()
            starts.append(at)  # the host star: stays on every byte but the slash
            symbols += list(text)
            at += len(text) + 1
            ends.append(at - 1)
            symbols.append(None)
        self.words = max(1, -(-at // 64))
        self.move = np.zeros((256, self.words), np.uint64)  # bits entered by a byte
        self.stay = np.zeros((256, self.words), np.uint64)
        self.begin = np.zeros(self.words, np.uint64)
        for bit, symbol in enumerate(symbols):
            if symbol is not None:
                self.put(self.move[symbol], bit + 1)
        for start, end in zip(starts, ends):
            self.put(self.begin, start)
            for byte in range(256):
                if byte != 0x2F:
                    self.put(self.stay[byte], start)
                self.put(self.stay[byte], end)
        self.ends = ends

    @staticmethod
    def put(mask: np.ndarray, bit: int) -> None:
        mask[bit // 64] |= np.uint64(1 << (bit % 64))

    def first_fits(self, urls: list[bytes]) -> np.ndarray:
        """Number of the winning rule of each canonical URL, -1 for none."""
        n = len(urls)
        order = sorted(range(n), key=lambda i: -len(urls[i]))
        lengths = np.array([len(urls[i]) for i in order])
        flat = np.frombuffer(b"".join(urls[i] for i in order) or b"\0", np.uint8)
        at = np.cumsum(lengths) - lengths
        d = np.tile(self.begin, (n, 1))
        one, top = np.uint64(1), np.uint64(63)
        for step in range(int(lengths[0]) if n else 0):
            live = int(np.searchsorted(-lengths, -step, side="left"))  # URLs longer than step come first
            byte = flat[at[:live] + step]
            state = d[:live]
            moved = state << one
            moved[:, 1:] |= state[:, :-1] >> top
            d[:live] = moved & self.move[byte] | state & self.stay[byte]
        out = np.full(n, -1)
        for number in range(len(self.rules) - 1, -1, -1):
            bit = self.ends[number]
            out[(d[:, bit // 64] >> np.uint64(bit % 64)) & one == one] = number
        result = np.empty(n, int)
        result[order] = out
        return result


def judge(rules: Sequence[tuple[str, str, str]], default: str):
    """Task code: page_id, host, path -> with rule and verdict."""
    automaton = Automaton(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                batch = whole.slice(i, 2000)
                urls = [f".{h}{p}".encode("utf-8", "surrogatepass") if h else b""
                        for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
                fit = [automaton.rules[k] if k >= 0 else None for k in automaton.first_fits(urls)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("page_id", "host", "path")]
                    + [pa.array([r and r[1] + r[2] for r in fit], pa.string()), pa.array([r[0] if r else default for r in fit], pa.string())],
                    ["page_id", "host", "path", "rule", "verdict"])
    return run


def url_verdicts(pages: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow",
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    parts = pages.select(F.col(id_col).cast("long").alias("page_id"),
                         F.translate(F.regexp_extract(url, HOST, 1), UPPER, LOWER).alias("host"),
                         F.regexp_extract(url, PATH, 1).alias("path"))
    return parts.mapInArrow(judge(rules, default), "page_id long, host string, path string, rule string, verdict string")


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> str:
    """The same verdicts as DuckDB SQL, rule by rule."""
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{HOST}', 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '{PATH}', 1) AS path FROM pages),
r(v, h, p) AS (VALUES {rows}),
m AS (SELECT u.page_id, u.host, u.path, r.h || r.p AS rule, r.v, row_number() OVER (PARTITION BY u.page_id
  ORDER BY length(r.h || r.p) DESC, r.v = 'allow', r.h || r.p) AS n
  FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.v, '{default}') AS verdict
FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.n = 1"""
