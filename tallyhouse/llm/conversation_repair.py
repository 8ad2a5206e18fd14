"""Cheapest repair of conversations, by an auction shortest-path algorithm on a lattice of whole costs.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`. Its rows by turn (NULL first, then role and a digest of
the text) are the layers of a lattice, with four nodes each: nothing yet, after s, after u, after a. Arcs are edits: Keep 0, Rerole to
user or assistant 3, Delete 4, Insert an empty message of user or assistant 3; a row kept or reroled that ends without
`.`, `!` or `?` costs 3 more, and blank or repeated rows can only be deleted.

Every node has a price, at most the cost of an arc out of it plus the price where that leads. A path grows along an arc for which both
are equal; where there is none, the price of its last node rises to the least such sum, and the path loses that node. When it
reaches the end, the price it began with is the least cost. Long conversations are done in stretches of `STRETCH` rows from the end,
whose nodes begin at the least price behind them, so the work grows with the rows. Prices are then tight on all cheapest paths;
of the tight arcs from which the end is reached, the one of least initial is followed from the start.

Two passes, each one shuffle by conversation. The first has no texts: Spark flags the repeated rows, tasks stream the sorted
rows, keep a byte for each and solve. The second streams the texts behind their conversation's edits and hashes what is
kept, so no text is held. A conversation is one sequence and its digest one chain, so it runs in one task, however long it is; there
it takes some tens of bytes a row.

NULL roles and texts count as one space. A role whose first character is not s, u or a (an empty one included) can't be kept. NULL
turns come first and count for no gap; a NULL conversation id is a conversation of its own. Rows that are equal in turn, role
and text are repetitions.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import settle

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
STRETCH = 32
# A row's byte: initial (s, u, a, other) and fault (none, truncated, blank, duplicate).
OTHER = 3
_FAULT = {"truncated": 1, "blank": 2, "duplicate": 3}
# Where an initial leads from each node, -1 for nowhere; where an inserted or reroled message leads, and its role.
_NEXT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
_FILL = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_BLANK = " \t\n\x0b\x0c\r"
# Short conversations come in few forms; so many solutions are kept in a task.
_SHORT, _CACHED = 16, 100_000
STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) with faults by crc32(`conv:turn`) % 20: dropped, emptied, without end marks, repeated, or of user.
    Dropped rows stay as `gone`, so that every conversation is known."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), filled[2].alias("role"), filled[3].alias("text"), (F.crc32(F.concat(filled[0], F.lit(":"), filled[1]).cast("binary")) % 20).alias("code"))
    text_now = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role_now = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv", "turn", role_now.alias("role"), text_now.alias("text"), (F.col("code") == 0).alias("gone"), times.alias("copy")).drop("copy")


def arcs(node: int, row: int | None) -> list[tuple[str, int, int]]:
    """(edit, cost, next node) out of a node before a row of this byte, None for the end; all but inserts use the row up."""
    out = []
    if row is not None:
        out.append(("D", DELETE, node))
    out.append(("I", INSERT, _FILL[node]))
    if row is not None and row >> 2 < 2:
        more = CUT_OFF * (row >> 2)
        if _NEXT[node][row & 3] >= 0:
            out.append(("K", KEEP + more, _NEXT[node][row & 3]))
        out.append(("R", REROLE + more, _FILL[node]))
    return out


# Out of every node for every byte, the end as byte 16: (cost, layers on, next node).
_OUT = [[[(c, 0 if e == "I" else 1, m) for e, c, m in arcs(node, row if row < 16 else None)] for node in range(4)] for row in range(17)]


def auction(rows: bytes, price: array, first: int, last: int, node: int) -> None:
    """Raise the prices of layers `first` to `last` - 1 until that of `node` in the first is its cost to the end.

    The prices of layer `last` are final; the end of the rows is one more layer, whose nodes may stop at 0 where a repair may end."""
    n = len(rows)
    path = [(first, node)]
    while True:
        layer, node = path[-1]
        if layer == last:
            return
        out = _OUT[rows[layer] if layer < n else 16][node]
        least, to = min((cost + price[4 * (layer + on) + there], (layer + on, there)) for cost, on, there in out)
        if layer == n and node in (0, 3):
            least, to = min((least, to), (0, (last, 0)))
        if price[4 * layer + node] < least:
            price[4 * layer + node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)


def solve(rows: bytes) -> tuple[int, str]:
    """The least cost, and of the cheapest repairs' edits in order the least by ASCII."""
    n = len(rows)
    # Layers 0 to n, and the end behind them with price 0.
    price = array("q", bytes(8 * 4 * (n + 2)))
    for lo in range(n // STRETCH * STRETCH, -1, -STRETCH):
        hi = min(lo + STRETCH, n + 1)
        if hi <= n:
            ground = min(price[4 * hi : 4 * hi + 4])
            price[4 * lo : 4 * hi] = array("q", [ground]) * (4 * (hi - lo))
        for node in range(4) if lo else (0,):
            auction(rows, price, lo, hi, node)
    return price[0], trace(rows, price)


def tight(rows: bytes, price: array, layer: int, node: int) -> list[tuple[str, int, int]]:
    """(edit, layer, node) of the arcs whose cost is the difference of their prices, by initial."""
    row = rows[layer] if layer < len(rows) else None
    found = [(edit, layer + (edit != "I"), to) for edit, cost, to in arcs(node, row) if price[4 * layer + node] == cost + price[4 * (layer + (edit != "I")) + to]]
    return sorted(found)


def trace(rows: bytes, price: array) -> str:
    n = len(rows)
    # Nodes from which tight arcs lead to the end.
    leads = bytearray(4 * (n + 1))
    for node in (0, 3):
        leads[4 * n + node] = price[4 * n + node] == 0
    for layer in range(n, -1, -1):
        ways = [tight(rows, price, layer, node) for node in range(4)]
        for _ in range(3):  # an insert leads to another node of the same layer
            for node in range(4):
                if any(leads[4 * a + b] for _, a, b in ways[node]):
                    leads[4 * layer + node] = 1
    out, layer, node = [], 0, 0
    while not (layer == n and node in (0, 3) and price[4 * n + node] == 0):
        edit, layer, node = next(way for way in tight(rows, price, layer, node) if leads[4 * way[1] + way[2]])
        out.append(edit)
    return "".join(out)


class Solver:
    """Solutions of a task; those of short conversations are kept."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, str]] = {}

    def __call__(self, rows: bytes) -> tuple[int, str]:
        if len(rows) > _SHORT:
            return solve(rows)
        if rows not in self.known:
            if len(self.known) >= _CACHED:
                self.known.clear()
            self.known[rows] = solve(rows)
        return self.known[rows]


def illegal(initials: np.ndarray) -> int:
    """Neighbours other than su, ua and au."""
    a, b = initials[:-1], initials[1:]
    return int(len(a) - (((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))).sum())


def _runs(column: pa.Array) -> list[tuple[int, int]]:
    """Where the runs of equal values lie, NULL equal to NULL."""
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    at = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(codes)]
    return list(zip(at[:-1], at[1:], strict=True))


class Conversation:
    """What the first pass keeps of a conversation."""

    def __init__(self, conv):
        self.conv, self.rows = conv, bytearray()
        self.low = self.high = None
        self.distinct = 0

    def add(self, rows: np.ndarray, turns: np.ndarray) -> None:
        """Bytes of rows and the turns among them that aren't NULL, in order."""
        self.rows += rows.tobytes()
        if len(turns):
            self.distinct += int((np.diff(turns) != 0).sum()) + (self.high is None or int(turns[0]) != self.high)
            self.low, self.high = int(turns[0]) if self.low is None else self.low, int(turns[-1])

    def result(self, solver: Solver) -> tuple:
        rows = np.frombuffer(bytes(self.rows), np.uint8)
        faults = np.bincount(rows >> 2, minlength=4).tolist()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = solver(bytes(self.rows))
        return self.conv, gaps, faults[2], faults[3], faults[1], illegal(rows & 3), cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """`conv`, its faults, the least cost and the edits, from (conv, turn, role, digest, first, last, gone)."""
    again = F.row_number().over(Window.partitionBy("conv", "gone", "role", "digest").orderBy("turn")) > 1
    fault = F.when(F.col("last") == "", _FAULT["blank"]).when(again, _FAULT["duplicate"]).when(~F.col("last").isin(".", "!", "?"), _FAULT["truncated"]).otherwise(0)
    first = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in (("s", 0), ("u", 1), ("a", 2)) for x in pair)), F.col("first")), F.lit(OTHER))
    coded = rows.repartition("conv").withColumn("row", (4 * fault + first).cast("int"))
    # The window is within a conversation, so the one shuffle does for both.
    streamed = coded.sortWithinPartitions("conv", "gone", "turn", "role", "digest").select("conv", "gone", "turn", "row")
    conv_type = rows.schema["conv"].dataType.simpleString()
    names = ["conv", *(x.split()[0] for x in STATS.split(", "))]
    kinds = [None, *(pa.string() if x.endswith("string") else pa.int64() for x in STATS.split(", "))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver, now = Solver(), None
        for batch in batches:
            done, kinds[0] = [], batch.schema.field(0).type
            here = ~batch.column(1).to_numpy(zero_copy_only=False)
            codes = batch.column(3).to_numpy().astype(np.uint8)
            has, turns = np.asarray(batch.column(2).is_valid()), batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi in _runs(batch.column(0)):
                conv = batch.column(0)[lo].as_py()
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result(solver))
                    now = Conversation(conv)
                own = here[lo:hi]
                now.add(codes[lo:hi][own], turns[lo:hi][own & has[lo:hi]])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True) if done else [()] * len(names), kinds, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(now.result(solver), kinds, strict=True)], names)

    return streamed.mapInArrow(run, f"conv {conv_type}, {STATS}")


class Rewriter:
    """Follows a conversation's edits over its rows and digests what is left."""

    def __init__(self, head: dict):
        self.head, self.at, self.node, self.begun = head, 0, 0, False
        self.digest = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode())
        self.begun = True

    def _inserts(self) -> None:
        while self.head["audit"][self.at : self.at + 1] == "I":
            self._line(_ROLE[self.node], "")
            self.node = _FILL[self.node]
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.head["audit"][self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
            self.node = _NEXT[self.node]["sua".index(role[0])]
        elif edit == "R":
            self._line(_ROLE[self.node], text)
            self.node = _FILL[self.node]

    def result(self) -> dict:
        self._inserts()
        return self.head | {"repaired_sha256": self.digest.hexdigest()}


def repair(rows: DataFrame) -> DataFrame:
    """`conv`, `gaps`, the counts of faults, `cost`, `audit` and `repaired_sha256` of every conversation in (conv, turn, role, text, gone).

    `gone` rows only tell that the conversation exists."""
    stripped = F.rtrim(F.col("text"), F.lit(_BLANK))
    keyed = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    found = settle(audits(keyed.select("conv", "turn", "role", "digest", F.left("role", F.lit(1)).alias("first"), F.right(stripped, F.lit(1)).alias("last"), "gone")), "repair-audits")
    stats = [x.split()[0] for x in STATS.split(", ")]
    texts = keyed.where(~F.col("gone")).select("conv", F.lit(1).alias("kind"), "turn", "role", "digest", "text", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in STATS.split(", ")))
    heads = found.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), *(F.lit(None).cast("string").alias(c) for c in ("role", "digest", "text")), *stats)
    # The edits come before their conversation's rows, which are in the order of the first pass.
    streamed = heads.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest").select("conv", "kind", "role", "text", *stats)
    names = ["conv", *stats, "repaired_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema = None, None
        for batch in batches:
            done = []
            schema = schema or pa.schema([(n, pa.string() if n == "repaired_sha256" else batch.schema.field(n).type) for n in names])
            kinds, roles, texts = batch.column(1).to_pylist(), batch.column(2), batch.column(3)
            for i, kind in enumerate(kinds):
                if kind == 0:
                    if now is not None:
                        done.append(now.result())
                    now = Rewriter({n: batch.column(n)[i].as_py() for n in names[:-1]})
                else:
                    now.add(roles[i].as_py(), texts[i].as_py())
            yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema)

    return streamed.mapInArrow(run, f"conv {rows.schema['conv'].dataType.simpleString()}, {STATS}, repaired_sha256 string")


def repair_damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`repair` of the damaged rows, for every id in `conv`."""
    return repair(damage(df, conv, turn, role, text)).withColumnRenamed("conv", conv)
