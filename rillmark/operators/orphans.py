"""References that lead nowhere, and what hangs on them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.operators.skew import hot_keys, salted_join
from rillmark.session import checkpointed


@dataclass(frozen=True)
class Presence:
    """When the keys of a referred table were there.

    ``df`` has one row per key and landing time: columns ``key`` and ``seen`` (any ordered type). ``deletes``: a key that
    is absent from the last landing at or before the reference counts as deleted.
    """

    df: DataFrame
    deletes: bool = False


@dataclass
class Reference:
    """A foreign key of ``child``: column ``column`` (cleaned), known at ``at`` (same type as ``seen``), to ``parent``."""

    child: str
    column: str
    parent: str
    at: str | None = None


@dataclass
class Graph:
    """Tables by name (rows with a unique ``rid`` expression are not needed: rows are told apart by all their columns)."""

    tables: dict[str, DataFrame]
    presence: dict[str, Presence]
    references: list[Reference] = field(default_factory=list)
    #: inherited links: (child, child column, parent, parent column)
    links: list[tuple[str, str, str, str]] = field(default_factory=list)
    #: a key with more rows than this, and more than a fiftieth of its table, is spread over several tasks
    hot_least: int = 100_000


def landings(p: Presence) -> DataFrame:
    """One row per key with the sorted array of its landing times; a key has at most as many entries as there are landings."""
    d = p.df.where("key is not null and seen is not null").groupBy("key", "seen").agg(F.lit(1).alias("_one"))
    return d.groupBy("key").agg(F.sort_array(F.collect_list("seen")).alias("_seen"))


def state_column(p: Presence, at: str | None) -> Column:
    """null for a sound reference, else missing, late or deleted; reads ``_seen`` and, with deletes, ``_all``."""
    gone = F.when(F.col("_seen").isNull(), "missing")
    if at is None:
        return gone
    gone = gone.when(F.element_at("_seen", 1) > F.col(at), "late")
    if p.deletes:
        current = F.array_max(F.filter("_all", lambda t: t <= F.col(at)))
        gone = gone.when(~F.array_contains("_seen", current), "deleted")
    return gone


def direct_orphans(df: DataFrame, ref: Reference, p: Presence, hot_least: int = 100_000) -> DataFrame:
    """Rows of ``df`` whose reference does not hold, with ``ref_field`` and ``orphan_state``.

    Null keys are no reference and give no row; a null ``at`` can only be ``missing``. Hot keys are salted.
    """
    dim = landings(p).withColumnRenamed("key", ref.column)
    facts = df.where(F.col(ref.column).isNotNull())
    joined = salted_join(facts, dim, ref.column, hot=hot_keys(facts, ref.column, least=hot_least))
    if p.deletes and ref.at:  # all landing times: one entry per load of the parent
        joined = joined.withColumn("_all", p.df.where("seen is not null").select(F.sort_array(F.collect_set("seen"))).scalar())
    joined = joined.withColumn("orphan_state", state_column(p, ref.at)).where("orphan_state is not null")
    return joined.drop("_seen", "_all").withColumn("ref_field", F.lit(ref.column))


def cascade(g: Graph, only: set[str] | None = None) -> dict[str, DataFrame]:
    """Orphan rows per table: the table's own columns, ``ref_field``, ``orphan_state`` and ``orphan_level`` (0 direct, n inherited over n links).

    Fixpoint: each round semi-joins the children of what the last round found, minus what is known already, until a round
    finds nothing. Rounds follow the links that exist, so a graph without cycles ends after its depth without an emptiness
    check; a cyclic one is cut by checkpoint() each round and ends when the frontier is empty. A row comes out once per field
    it is an orphan by, at the lowest level, however many paths lead to it; equal rows of a table stay several. Tables that
    several references or links use are written down once. ``only``: tables wanted.
    """
    wanted = set(g.tables) if only is None else set(only)
    needed = _ancestors(g, wanted)
    uses = [r.child for r in g.references if r.child in needed] + [c for c, _, _, _ in g.links if c in needed]
    tables = {t: checkpointed(df) if uses.count(t) > 1 else df for t, df in g.tables.items()}
    used = {r.parent for r in g.references if r.child in needed}
    presence = {k: Presence(checkpointed(p.df.distinct()), True) if p.deletes and k in used else p for k, p in g.presence.items()}
    found: dict[str, list[DataFrame]] = {}
    front: dict[str, list[DataFrame]] = {}
    for r in g.references:
        if r.child in needed:
            d = direct_orphans(tables[r.child], r, presence[r.parent], g.hot_least).withColumn("orphan_level", F.lit(0))
            found.setdefault(r.child, []).append(d)
            front.setdefault(r.child, []).append(d)
    cyclic = _has_cycle(g)
    links_found: dict[int, str] = {}  # frames are kept in ``found``, so their ids stay theirs
    level = 0
    while front:
        level += 1
        nxt: dict[str, list[DataFrame]] = {}
        for child, ccol, parent, pcol in g.links:
            if parent not in front or child not in needed:
                continue
            bad = front[parent][0].select(F.col(pcol).alias(ccol))
            for more in front[parent][1:]:
                bad = bad.unionByName(more.select(F.col(pcol).alias(ccol)))
            cols = tables[child].columns
            hit = tables[child].join(bad.where(F.col(ccol).isNotNull()).distinct(), ccol, "left_semi")
            hit = hit.select(*cols).withColumn("ref_field", F.lit(ccol)).withColumn("orphan_state", F.lit("inherited")).withColumn("orphan_level", F.lit(level))
            # what this link has found before: whole rows, as another row with the same key value may be new
            for k in [k for k in found.get(child, []) + nxt.get(child, []) if links_found.get(id(k)) == ccol]:
                k = k.select(*[F.col(c).alias(f"_k_{c}") for c in cols]).distinct()
                hit = hit.join(k, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cols], "left_anti")
            if cyclic:
                hit = checkpointed(hit)
                if hit.isEmpty():
                    continue
            links_found[id(hit)] = ccol
            nxt.setdefault(child, []).append(hit)
        for t, parts in nxt.items():
            found.setdefault(t, []).extend(parts)
        front = nxt
    out = {}
    for t in wanted:
        parts = found.get(t, [])
        for i, p in enumerate(parts):
            out[t] = p.select(*tables[t].columns, "ref_field", "orphan_state", "orphan_level") if i == 0 else out[t].unionByName(p.select(*out[t].columns))
    return out


def _ancestors(g: Graph, wanted: set[str]) -> set[str]:
    need = set(wanted)
    while True:
        more = {p for c, _, p, _ in g.links if c in need} - need
        if not more:
            return need
        need |= more


def _has_cycle(g: Graph) -> bool:
    edges = {(p, c) for c, _, p, _ in g.links}
    nodes = {x for e in edges for x in e}
    while nodes:
        free = {n for n in nodes if not any(c == n for p, c in edges)}
        if not free:
            return True
        nodes -= free
        edges = {(p, c) for p, c in edges if p not in free}
    return False
