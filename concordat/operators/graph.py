"""Dependency graphs of objects: edges by name, waves, order, cycles, closure and missing references.

Results of a row for each object (waves, components) are worked out on the driver for graphs of up to DRIVER_EDGES edges, larger graphs with joins. The
closure has a row for each pair that a way connects, which a short list of edges doesn't bound, so that only the first DRIVER_PAIRS of them are
looked for on the driver; beyond that it is a table that grows by doubling, a round for each doubling of the longest way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import durable
from .ranks import numbered

#: Edges that the driver takes at most, and pairs of a closure.
DRIVER_EDGES, DRIVER_PAIRS = 1_000_000, 200_000
#: How tables of a row for each object are joined: broadcasts of them would go through the driver, one for each join.
SORTED = "merge"


def edges(objects: DataFrame) -> DataFrame:
    """(src, dst) for each object (fqn, name, depends_on) and each object that it depends on: by full name, else by bare name
    (the same schema first, then the least full name), whatever the case; without edges to itself or repeats. Names are looked up among the least full
    names for a full, a schema's bare and a bare name, so that a bare name in a thousand schemas is one row."""
    schema, bare = (lambda c: F.regexp_extract(F.upper(c), r"^(.*)\.[^.]*$", 1)), lambda c: F.regexp_extract(F.upper(c), r"([^.]*)$", 1)
    wanted = objects.select("fqn", F.explode("depends_on").alias("dep")).withColumns({"full": F.upper("dep"), "schema": schema("fqn"), "bare": bare("dep")})
    known = objects.select("fqn", F.upper("fqn").alias("full"), schema("fqn").alias("schema"), F.upper("name").alias("bare"))
    for level, keys in (("exact", ["full"]), ("same", ["schema", "bare"]), ("any", ["bare"])):
        wanted = wanted.join(known.groupBy(*keys).agg(F.min("fqn").alias(level)).hint(SORTED), keys, "left")
    found = wanted.select(F.col("fqn").alias("src"), F.coalesce("exact", "same", "any").alias("dst"))
    return found.where("src <> dst").distinct()


def waves(objects: DataFrame, deps: DataFrame) -> DataFrame:
    """(fqn, wave, in_cycle): wave 0 needs nothing; an object comes after all that it needs. Members of cycles and what lies
    downstream of them are the last wave. Each round peels the objects whose needs are met."""
    spark = objects.sparkSession
    names, rows = objects.select("fqn").distinct().limit(DRIVER_EDGES + 1).collect(), deps.select("src", "dst").limit(DRIVER_EDGES + 1).collect()
    if max(len(names), len(rows)) > DRIVER_EDGES:
        return joined_waves(objects, deps)
    needs: dict[str, set[str]] = {r["fqn"]: set() for r in names}
    for r in rows:
        if r["src"] in needs and r["dst"] in needs:
            needs[r["src"]].add(r["dst"])
    out, wave = [], 0
    while needs:
        ready = sorted(x for x, d in needs.items() if not d)
        if not ready:
            out += [(x, wave, True) for x in sorted(needs)]
            break
        out += [(x, wave, False) for x in ready]
        gone = set(ready)
        needs = {x: d - gone for x, d in needs.items() if x not in gone}
        wave += 1
    return spark.createDataFrame(out, "fqn string, wave int, in_cycle boolean")


def joined_waves(objects: DataFrame, deps: DataFrame) -> DataFrame:
    """waves() with joins: each round takes the objects without an edge that is left; a durable table after each cuts the lineage."""
    left = objects.select("fqn").distinct()
    known = left.select(F.col("fqn").alias("dst"))
    edge = durable(deps.select("src", "dst").distinct().join(known, "dst", "left_semi").join(left.select(F.col("fqn").alias("src")), "src", "left_semi"), "edges")
    out = left.limit(0).select("fqn", F.lit(0).alias("wave"), F.lit(False).alias("in_cycle"))
    wave = 0
    while left.limit(1).count():
        ready = durable(left.join(edge.select(F.col("src").alias("fqn")).distinct(), "fqn", "left_anti"), "ready")
        if not ready.limit(1).count():
            return out.unionByName(left.select("fqn", F.lit(wave).alias("wave"), F.lit(True).alias("in_cycle")))
        out = out.unionByName(ready.select("fqn", F.lit(wave).alias("wave"), F.lit(False).alias("in_cycle")))
        left = durable(left.join(ready, "fqn", "left_anti"), "left")
        edge = durable(edge.join(ready.select(F.col("fqn").alias("dst")), "dst", "left_anti").select("src", "dst"), "edges")
        wave += 1
    return out


def topological_order(waved: DataFrame) -> DataFrame:
    """(fqn, place, cycle_warning): by wave, then by name."""
    return numbered(waved, F.col("wave"), F.col("fqn")).select("fqn", F.col("place").cast("int").alias("place"), F.col("in_cycle").alias("cycle_warning"))


def closure(deps: DataFrame) -> DataFrame:
    """(src, dst, depth) for all that src needs, directly or not, by the shortest way, however long. Each pair is found once, so neither cycles nor
    many ways to one object repeat work."""
    spark = deps.sparkSession
    rows = deps.select("src", "dst").limit(DRIVER_PAIRS + 1).collect()
    if len(rows) > DRIVER_PAIRS:
        return doubled_closure(deps)
    needs: dict[object, list[object]] = {}
    for r in rows:
        needs.setdefault(r["src"], []).append(r["dst"])
    out: list[tuple[object, object, int]] = []
    for start in needs:
        seen: dict[object, int] = {}
        edge, depth = [start], 0
        while edge:
            depth += 1
            edge = [d for d in dict.fromkeys(d for s in edge for d in needs.get(s, ())) if d not in seen]
            seen |= dict.fromkeys(edge, depth)
            if len(out) + len(seen) > DRIVER_PAIRS:
                return doubled_closure(deps)
        out += [(start, d, n) for d, n in seen.items()]
    kind = dict(deps.dtypes)["src"]
    return spark.createDataFrame(out, f"src {kind}, dst {kind}, depth int")


def doubled_closure(deps: DataFrame) -> DataFrame:
    """closure() with joins. Objects that nothing needs lie on no way between others, so they are set aside, again and again while these are half of the
    edges that are left; the closure of the rest is found by doubling, and each layer then takes what the objects that it needs reach, once."""
    edge, layers = deps.select("src", "dst"), []
    while True:
        needed = edge.select(F.col("dst").alias("src")).distinct().withColumn("needed", F.lit(True))
        held = durable(edge.join(needed.hint(SORTED), "src", "left").distinct(), "edges")  # distinct where src lies already
        rows, left = held.agg(F.count("*"), F.count("needed")).first()
        if 2 * left > rows or not rows:
            break
        layers.append(held.where("needed IS NULL").select("src", "dst"))
        edge = held.where("needed").select("src", "dst")
    found = doubled_pairs(held.select("src", "dst", F.lit(1).alias("depth")))
    for k in range(len(layers) - 1, -1, -1):
        outer = layers[k]
        step = outer.withColumnRenamed("dst", "mid").join(found.select(F.col("src").alias("mid"), "dst", (F.col("depth") + 1).alias("depth")).hint(SORTED), "mid").select("src", "dst", "depth")
        pairs = outer.withColumn("depth", F.lit(1)).unionByName(step).groupBy("src", "dst").agg(F.min("depth").alias("depth"))
        found = found.unionByName(durable(pairs, "pairs") if k else pairs)
    return found


def doubled_pairs(pairs: DataFrame) -> DataFrame:
    """The closure of edges (src, dst, depth 1), each there once. With all pairs up to a distance and those at just that distance in hand, a way of up to
    twice it is one of the latter and one of the former, so each round doubles the distance, and comes on a pair once for each object halfway. Pairs of
    before have the least depths and stay."""
    found, reach = pairs, 1
    while True:
        far = found.where(F.col("depth") == reach).select("src", F.col("dst").alias("mid"))
        step = far.join(found.select(F.col("src").alias("mid"), "dst", (F.col("depth") + reach).alias("depth")).hint(SORTED), "mid").select("src", "dst", "depth")
        found = durable(found.unionByName(step).groupBy("src", "dst").agg(F.min("depth").alias("depth")), "pairs")
        reach *= 2
        if (found.agg(F.max("depth")).first()[0] or 0) < reach:
            return found  # nothing is farther


def components(deps: DataFrame) -> DataFrame:
    """(node, component) for each node that an edge of deps (src, dst) names: the least node of those that it reaches and that reach it."""
    rows = deps.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").limit(DRIVER_EDGES + 1).collect()
    if len(rows) > DRIVER_EDGES:
        return joined_components(deps)
    needs: dict[object, list[object]] = {}
    for r in rows:
        needs.setdefault(r["src"], []).append(r["dst"])
        needs.setdefault(r["dst"], [])
    place: dict[object, int] = {}
    low: dict[object, int] = {}
    stack: list[object] = []
    out: list[tuple[object, object]] = []
    held: set[object] = set()
    for start in needs:
        if start in place:
            continue
        place[start] = low[start] = len(place)
        stack.append(start)
        held.add(start)
        way = [(start, iter(needs[start]))]
        while way:
            node, rest = way[-1]
            following = next((d for d in rest if d not in place or d in held), None)
            if following is None:
                way.pop()
                if way:
                    low[way[-1][0]] = min(low[way[-1][0]], low[node])
                if low[node] == place[node]:
                    members = []
                    while not members or members[-1] != node:
                        members.append(stack.pop())
                    held.difference_update(members)
                    out += [(m, min(members)) for m in members]
            elif following in place:
                low[node] = min(low[node], place[following])
            else:
                place[following] = low[following] = len(place)
                stack.append(following)
                held.add(following)
                way.append((following, iter(needs[following])))
    kind = dict(deps.dtypes)["src"]
    return deps.sparkSession.createDataFrame(out, f"node {kind}, component {kind}")


def joined_components(deps: DataFrame) -> DataFrame:
    """components() with joins."""
    edge = durable(deps.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
    nodes = edge.select(F.col("src").alias("node")).union(edge.select("dst")).distinct()
    return nodes.join(rings(edge), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def rings(deps: DataFrame) -> DataFrame:
    """(node, component) of components() of two nodes or more. Nodes that nothing needs, or that need nothing, are components of their own and trimmed,
    the former before edges are written, again and again; of what is left, each node takes the largest name that reaches it, and those that reach the
    node of their name through nodes of that name are its component."""
    edge = deps.select("src", "dst").where("src <> dst")
    needed = edge.select(F.col("dst").alias("src")).distinct()
    edge = durable(edge.join(needed.hint(SORTED), "src", "left_semi").distinct(), "edges")  # distinct where src lies already
    found: list[DataFrame] = []
    while edge.limit(1).count():
        rows, last = edge.count(), -1
        while rows != last:
            ins, outs = edge.select(F.col("dst").alias("src")).distinct(), edge.select(F.col("src").alias("dst")).distinct()
            edge = durable(edge.join(ins.hint(SORTED), "src", "left_semi").join(outs.hint(SORTED), "dst", "left_semi").select("src", "dst"), "edges")
            last, rows = rows, edge.count()
        if not rows:
            break
        name = durable(edge.select(F.col("src").alias("node")).union(edge.select("dst")).distinct().withColumn("name", F.col("node")), "names")
        changed = 1
        while changed:
            heard = edge.join(name.withColumnRenamed("node", "src"), "src").groupBy(F.col("dst").alias("node")).agg(F.max("name").alias("heard"))
            name = durable(name.join(heard, "node", "left").select("node", F.greatest("name", "heard").alias("name"), (F.coalesce("heard", "name") > F.col("name")).alias("changed")), "names")
            changed = name.where("changed").limit(1).count()
            name = name.drop("changed")
        inside = durable(edge.join(name.withColumnRenamed("node", "src"), "src").join(name.select(F.col("node").alias("dst"), F.col("name").alias("other")), "dst").where("name = other").select("src", "dst", "name"), "inside")
        reached = durable(name.where("node = name"), "reached")
        front = reached
        while front.limit(1).count():  # backwards from the node of the name
            step = inside.join(front.select(F.col("node").alias("dst"), "name"), ["dst", "name"]).select(F.col("src").alias("node"), "name").distinct()
            front = durable(step.join(reached, ["node", "name"], "left_anti"), "front")
            reached = durable(reached.unionByName(front), "reached")
        found.append(reached)
        gone = reached.select(F.col("node").alias("src"))
        edge = durable(edge.join(gone, "src", "left_anti").join(gone.withColumnRenamed("src", "dst"), "dst", "left_anti").select("src", "dst"), "edges")
    named = deps.limit(0).select(F.col("src").alias("node"), F.col("src").alias("name"))
    for f in found:
        named = named.unionByName(f)
    least = named.groupBy("name").agg(F.min("node").alias("component"), F.count("*").alias("n")).where("n > 1")
    return named.join(least, "name").select("node", "component")


def condensed(deps: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges between components (src, dst), each once."""
    ends = deps.select("src", "dst").join(parts.select(F.col("node").alias("src"), F.col("component").alias("a")).hint(SORTED), "src").join(parts.select(F.col("node").alias("dst"), F.col("component").alias("b")).hint(SORTED), "dst")
    return ends.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def reachable(deps: DataFrame) -> DataFrame:
    """(src, dst) for all that src needs, directly or not, itself included if it lies on a cycle: the closure between components, and all pairs within one."""
    deps = durable(deps.select("src", "dst"), "edges")  # found once for all uses
    parts = durable(components(deps), "components")
    members = parts.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    alone = deps.where("src = dst").select(F.col("src").alias("component")).distinct()
    within = members.union(alone).distinct().select(F.col("component").alias("src"), F.col("component").alias("dst"))
    pairs = closure(condensed(deps, parts)).select("src", "dst").unionByName(within)
    ends = pairs.join(parts.select(F.col("component").alias("src"), F.col("node").alias("a")).hint(SORTED), "src").join(parts.select(F.col("component").alias("dst"), F.col("node").alias("b")).hint(SORTED), "dst")
    return ends.select(F.col("a").alias("src"), F.col("b").alias("dst"))


def cycle_members(deps: DataFrame) -> DataFrame:
    """Objects that need themselves: members of components of two or more, and those with an edge to themselves."""
    parts = components(deps)
    large = parts.join(parts.groupBy("component").agg(F.count("*").alias("n")).where("n > 1"), "component", "left_semi").select(F.col("node").alias("fqn"))
    return large.union(deps.where("src = dst").select("src")).distinct()


def base_tables(objects: DataFrame, deps: DataFrame) -> DataFrame:
    """For each view the tables at the end of its ways."""
    tables = objects.where("type = 'TABLE'").select(F.col("fqn").alias("dst"))
    views = objects.where("type = 'VIEW'").select(F.col("fqn").alias("src"))
    return reachable(deps).join(tables.hint(SORTED), "dst", "left_semi").join(views.hint(SORTED), "src", "left_semi").groupBy("src").agg(F.array_join(F.array_sort(F.collect_set("dst")), ",").alias("base_tables")).withColumnRenamed("src", "fqn")


def missing_references(objects: DataFrame) -> DataFrame:
    """Names that objects depend on and that no object has, full or bare."""
    o = objects.select("fqn", F.explode("depends_on").alias("missing")).distinct()
    names = objects.select(F.upper("fqn").alias("n")).union(objects.select(F.upper("name"))).distinct()
    return o.join(names, (F.upper("missing") == F.col("n")), "left_anti")


def references(text: Column) -> Column:
    """Names of tables that a statement reads or writes, lower-case and sorted."""
    names = F.regexp_extract_all(F.regexp_replace(F.lower(text), r"--[^\n]*|/\*[\s\S]*?\*/|[\[\]\"`]", ""), F.lit(r"\b(?:from|join|into|update|exec|execute)\s+([a-z_][\w$]*(?:\.[a-z_][\w$]*)*)"), 1)
    return F.array_sort(F.array_distinct(names))
