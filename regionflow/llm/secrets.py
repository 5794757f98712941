"""Secret scans with multipart credential linking.

Base findings are matches of three patterns. Further, weaker parts of credentials are looked for: short assignments,
short access identifiers, secrets without a name, and endpoints. Parts of a text are joined by interval: two parts are
in one scope if they are at most SCOPE code points apart and no blank line lies between them. A weak part is reported
only where its complement is in its scope: an access identifier needs a secret, a secret needs an access identifier,
an endpoint needs a secret that is itself linked or strong. Joins run over sorted starts, so a text costs its length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCOPE = 300
#: Base kinds in their order: pattern, and what of a match must have how many characters.
BASE = {
    "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
#: Where a match of assign can begin; hex matches that are long enough.
_ASSIGN_HINT = re.compile(r"(?ai)passw|secret|token|api_?key")
_HEX_LONG = re.compile(r"[0-9a-f]{16,}")
#: Parts that count only next to their complement, in the order of kinds after the base ones.
WEAK = {
    "weak_access": re.compile(r"(?a)\b(?:AKIA|ASIA|AGPA|AROA)[A-Z0-9]{8,}|(?<![A-Za-z0-9])(?i:access_?key(?:_?id)?|client_?id|user_?name|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.@-]{4,}"),
    "weak_secret": re.compile(r"(?a)(?i:password|passwd|secret|token|api_?key|pwd|client_secret)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}|(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/_=-])"),
    "endpoint": re.compile(r"(?a)\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9_.:@/-]{4,}|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?\b"),
}
KINDS = [*BASE, *WEAK]
ROLE = {"assign": "secret", "access": "access", "weak_access": "access", "weak_secret": "secret", "endpoint": "endpoint"}
_HINT = re.compile(r"(?a)AKIA|ASIA|AGPA|AROA|(?i:access_?key|client_?id|user_?name|login)")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """start, end, kind of the base findings: for each kind its leftmost non-overlapping matches, less those that
    are too short."""
    out = []
    if _ASSIGN_HINT.search(text):
        pattern, group, least = BASE["assign"]
        out += [(*m.span(), "assign") for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in BASE["access"][0].finditer(text) if len(m[0]) >= BASE["access"][2]]
    out += [(*m.span(), "hex") for m in _HEX_LONG.finditer(text)]  # a long match of [0-9a-f]+ is a whole run
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def linked_spans(text: str, base: list[tuple[int, int, str]]) -> tuple[list[tuple[int, int, str]], list[tuple]]:
    """The weak parts whose complement co-occurs, and the links: (access, secret, endpoint or None), as (start, end)."""
    strong = [x for x in base if x[2] != "hex"]
    if not strong and not _HINT.search(text):  # no access identifier, and no strong secret that an endpoint could stand beside
        return [], []
    parts = list(strong)
    for kind, pattern in WEAK.items():
        taken = [x for x in parts if ROLE[x[2]] == ROLE[kind]]
        parts += [(a, b, kind) for a, b in (m.span() for m in pattern.finditer(text)) if not any(a < e and s < b for s, e, _ in _near(taken, a, b, 0))]
        parts.sort()
    breaks = [m.start() for m in re.finditer(r"\n\s*\n", text)]

    def scope(x: tuple, role: str) -> list[tuple]:
        """The parts of a role within reach of x: an interval join over sorted starts."""
        near = _near(by_role[role], x[0], x[1], SCOPE)
        return [y for y in near if bisect_left(breaks, min(x[1], y[1])) == bisect_left(breaks, max(x[0], y[0]))]

    by_role = {r: [x for x in parts if ROLE[x[2]] == r] for r in ("access", "secret", "endpoint")}
    kept, links = set(), []
    for x in by_role["access"]:
        others = scope(x, "secret")
        if not others:
            continue
        kept.add(x)
        kept.update(others)
        y = min(others, key=lambda o: (max(o[0] - x[1], x[0] - o[1], 0), o))
        ends = scope(y, "endpoint")
        links.append((x[:2], y[:2], ends[0][:2] if ends else None))
    for x in by_role["endpoint"]:
        if any(y in kept or y[2] == "assign" for y in scope(x, "secret")):
            kept.add(x)
    return sorted(x for x in kept if x[2] in WEAK), links


def _near(sorted_parts: list[tuple], a: int, b: int, reach: int) -> list[tuple]:
    """Those of sorted, disjoint parts that are at most reach away from [a, b)."""
    i = bisect_left(sorted_parts, (a - reach,))
    while i and sorted_parts[i - 1][1] >= a - reach:
        i -= 1
    out = []
    while i < len(sorted_parts) and sorted_parts[i][0] <= b + reach:
        out.append(sorted_parts[i])
        i += 1
    return out


def find_secrets(df: DataFrame, text_col: str = "text", out_col: str = "secrets") -> DataFrame:
    """df with text_col replaced by out_col: struct of base and weak, arrays of (kind, start, end) in code points, end
    exclusive, by start and then kind, and links, (access_start, secret_start, endpoint_start or null). Null and empty
    texts have none. All rows stay; a column of df that bears the new name is replaced."""
    keep = [c for c in df.columns if c not in (text_col, out_col)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_col))
    span = "array<struct<kind:string,start:int,end:int>>"
    kind = f"struct<base:{span},weak:{span},links:array<struct<access_start:int,secret_start:int,endpoint_start:int>>>"
    fields = [f for f in rows.schema.fields if f.name != text_col]
    schema = T.StructType([*fields, T.StructField(out_col, T.StructType.fromDDL(f"x {kind}")[0].dataType)])
    pa_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    pa_link = pa.list_(pa.struct([("access_start", pa.int32()), ("secret_start", pa.int32()), ("endpoint_start", pa.int32())]))

    def one(text: str | None) -> dict:
        base = base_spans(text) if text else []
        weak, links = linked_spans(text, base) if text else ([], [])
        listed = lambda xs: [{"kind": k, "start": a, "end": b} for a, b, k in xs]
        return {
            "base": listed(base), "weak": listed(weak),
            "links": [{"access_start": a[0], "secret_start": s[0], "endpoint_start": e and e[0]} for a, s, e in links],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array((one(t.as_py()) for t in b.column(len(keep))), pa.struct([("base", pa_span), ("weak", pa_span), ("links", pa_link)]))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], found], [*keep, out_col])

    return rows.mapInArrow(run, schema)
