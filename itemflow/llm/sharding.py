"""Shards by balanced label propagation: linked rows move to the shards of their neighbours, within quotas.

Rows that share a group are linked. Every row starts in the shard of its id's hash; a round moves
the rows of a group from shards with few of them to shards with more, most gain first, as far as
the targets have room. Rows of one group in one shard are alike, so a round works on their numbers: a
table of groups and shards, however many rows a group has. Rows without a link fill what is left.
Counts of rows per shard end at most one apart; a group too large for a shard fills several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemflow.llm.scratch import stored

ROUNDS = 8
#: Proposals of like gain are accepted in so many portions.
PORTIONS = 32


def balanced_shards(
    rows: DataFrame, n_shards: int, *, id_col: str = "doc_id", group_col: str = "group", rounds: int = ROUNDS
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard); other columns stay.

    ``slot`` orders a shard's rows by nothing in particular. Rows with a null group have no link. Equal
    ids and whole rows that repeat are rows like others. An empty table stays empty. The driver sees
    numbers of shards and of gains only, never of rows or groups.
    """
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    start = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(n_shards)).cast("int")
    salt = F.pmod(F.xxhash64(F.col(id_col), F.lit(8)), F.lit(_salts(rows)))
    base = rows.select(*own, F.col(group_col).alias("_group"), start.alias("_from"), salt.alias("_salt"), F.expr("uuid()").alias("_row"))
    base = stored(base, "shard-rows")

    state = base.where("_group IS NOT NULL").groupBy(F.col("_group").alias("g"), F.col("_from").alias("shard")).agg(F.count("*").alias("n"))
    sizes = state.groupBy("g").agg(F.sum("n").alias("size")).where("size > 1")
    state = stored(state.join(sizes, "g").select("g", "shard", "n"), "shard-state")
    total = base.count()
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    load = _load(state, n_shards)
    state = _fit(state, load, room, n_shards)
    for _ in range(rounds):
        load = _load(state, n_shards)
        # what is nearly full takes no more, so that its pieces can go where there is room
        free = [f if (f := room[s] - load[s]) > room[s] // 50 else 0 for s in range(n_shards)]
        moved = _round(state, free, n_shards)
        if moved is None:
            break
        state = moved
    return _placed(base, own, state, room, _load(state, n_shards), n_shards)


def _salts(rows: DataFrame) -> int:
    return 4 * max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _load(state: DataFrame, n_shards: int) -> list[int]:
    found = {r[0]: r[1] for r in state.groupBy("shard").agg(F.sum("n")).collect()}
    return [found.get(s, 0) for s in range(n_shards)]


def _lookup(values: list[float]):
    """A number for each shard, as an expression of ``shard``."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("shard").cast("int") + 1)


def _fit(state: DataFrame, load: list[int], room: list[int], n_shards: int) -> DataFrame:
    """Make the start fit: shards that the hash has filled beyond their room give an even share of each group away."""
    over = [max(0, load[s] - room[s]) for s in range(n_shards)]
    if not any(over):
        return state
    free = [max(0, room[s] - load[s]) for s in range(n_shards)]
    # the surplus of a shard is taken from its groups in the order of their hashes, by running sums
    ranked = _running(state, F.xxhash64("g"))
    part = F.greatest(F.lit(0), F.least(F.col("n"), F.col("before") + F.col("n") - (_lookup(load) - _lookup(over))))
    split = stored(ranked.withColumn("leaves", part), "shard-fit")
    stays = split.select("g", "shard", (F.col("n") - F.col("leaves")).alias("n")).where("n > 0")
    leaving = split.where("leaves > 0").select("g", F.lit(0).alias("shard"), F.col("leaves").alias("n"))
    return stored(_merged(stays.unionByName(_poured(leaving, free))), "shard-state")


def _poured(pieces: DataFrame, free: list[int]) -> DataFrame:
    """Deal pieces ``(g, shard, n)`` into the free places of the shards, one shard after the other."""
    ends, total = [], 0
    for f in free:
        total += f
        ends.append(total)
    ranked = _running(pieces, F.xxhash64("g"))
    bounds = F.array(*(F.struct(F.lit(s).alias("to"), F.lit(e - f).alias("low"), F.lit(e).alias("high")) for s, (e, f) in enumerate(zip(ends, free, strict=True)) if f))
    one = ranked.select("g", "n", "before", F.explode(bounds).alias("b"))
    took = F.least(F.col("before") + F.col("n"), F.col("b.high")) - F.greatest("before", F.col("b.low"))
    return one.select("g", F.col("b.to").alias("shard"), took.alias("n")).where("n > 0")


def _running(pieces: DataFrame, order) -> DataFrame:
    """``before``: the sum of ``n`` of the same shard's pieces ahead, by salted sums rather than one long window."""
    salts = _salts(pieces)
    salted = pieces.withColumn("_o", order).withColumn("_s", F.pmod(F.shiftright("_o", 16), F.lit(salts)))
    sums = salted.groupBy("shard", "_s").agg(F.sum("n").alias("_n"))
    sums = sums.select("shard", "_s", F.expr("sum(_n) OVER (PARTITION BY shard ORDER BY _s) - _n").alias("_ahead"))
    inner = F.expr("coalesce(sum(n) OVER (PARTITION BY shard, _s ORDER BY _o, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    return salted.withColumn("_in", inner).join(sums, ["shard", "_s"]).select(*pieces.columns, (F.col("_ahead") + F.col("_in")).alias("before"))


def _merged(state: DataFrame) -> DataFrame:
    return state.groupBy("g", "shard").agg(F.sum("n").alias("n"))


def _round(state: DataFrame, free: list[int], n_shards: int) -> DataFrame | None:
    """One round of moves, or none if nothing moves."""
    # a group's pieces, at most one for each shard, and the best of those shards that have room
    order = F.struct("n", F.xxhash64("g", "shard").alias("h"), "shard")
    open_ = F.when(_lookup(free) > 0, order)
    best = state.groupBy("g").agg(F.max(open_).alias("best"), F.sum("n").alias("size"), F.count("*").alias("pieces"))
    # a small group whose shards are all full meets in a shard with room, if it is in pieces
    some = [s for s in range(n_shards) if free[s] > 0]
    if not some:
        return None
    other = F.element_at(F.array(*map(F.lit, some)), F.pmod(F.xxhash64("g", F.lit(4)), F.lit(len(some))).cast("int") + 1)
    away = F.struct(F.col("size").alias("n"), F.lit(0).cast("long").alias("h"), other.alias("shard"))
    small = (F.col("pieces") > 1) & (F.col("size") * 4 <= F.element_at(F.array(*map(F.lit, free)), other + 1))
    best = best.withColumn("best", F.coalesce("best", F.when(small, away))).where("best IS NOT NULL").select("g", "best")
    # a piece in a full shard gives way to an equal one elsewhere, which could not come to it
    gives = (_lookup(free) <= 0) & (F.col("n") <= F.col("best.n"))
    wish = state.join(best, "g").where((F.col("shard") != F.col("best.shard")) & ((order < F.col("best")) | gives))
    portion = F.pmod(F.xxhash64("g", F.lit(3)), F.lit(PORTIONS)).cast("int")
    gain = F.floor(F.log2((F.col("best.n") - F.col("n") + 1).cast("double"))).cast("int")
    wish = stored(
        wish.select("g", "shard", "n", F.col("best.shard").alias("to"), gain.alias("gain"), portion.alias("portion")), "shard-wish"
    )
    demand = wish.groupBy("to", "gain", "portion").agg(F.sum("n").alias("n")).collect()
    accepted, left = [], dict(enumerate(free))
    for to, gain_, portion_, n in sorted(demand, key=lambda r: (r[0], -r[1], r[2])):
        # large pieces can be divided; portions of small ones that do not fit leave the room to others
        share = 1.0 if n <= left[to] else left[to] / n if gain_ >= 3 else 0.0
        left[to] -= min(n, left[to]) if share else 0
        accepted.append((to, gain_, portion_, share))
    if not any(a[3] > 0 for a in accepted):
        return None
    spark = state.sparkSession
    quotas = spark.createDataFrame(accepted, "to int, gain int, portion int, share double")
    moves = wish.join(F.broadcast(quotas), ["to", "gain", "portion"])
    moves = moves.withColumn("m", F.floor(F.col("n") * F.col("share")).cast("long")).where("m > 0")
    moves = stored(moves.select("g", "shard", "to", "m"), "shard-moves")
    if moves.isEmpty():
        return None
    away = moves.select("g", "shard", (-F.col("m")).alias("n"))
    there = moves.select("g", F.col("to").alias("shard"), F.col("m").alias("n"))
    return stored(_merged(state.unionByName(away).unionByName(there)).where("n > 0"), "shard-state")


def _placed(base: DataFrame, own: list[str], state: DataFrame, room: list[int], load: list[int], n_shards: int) -> DataFrame:
    """A shard and a slot for each row, from the numbers alone."""
    # linked rows: a row's rank in its group says which piece it is in
    linked = base.join(state.select(F.col("g").alias("_group")).distinct(), "_group", "left_semi")
    ranked = _ranked(linked, ["_group"], "_rank")
    span = "OVER (PARTITION BY g ORDER BY shard)"
    pieces = state.select("g", "shard", "n", F.expr(f"sum(n) {span} - n").alias("low"), F.expr(f"sum(n) {span}").alias("high"))
    pieces = _running(pieces, F.xxhash64("g"))
    bounds = pieces.groupBy("g").agg(F.collect_list(F.struct("low", "high", "shard", "before")).alias("pieces"))
    at = F.filter("pieces", lambda p: (p["low"] <= F.col("_rank")) & (F.col("_rank") < p["high"]))[0]
    first = ranked.join(bounds, F.col("_group") == F.col("g")).withColumn("_at", at)
    first = first.select(*own, F.col("_at.shard").alias("shard"), (F.col("_at.before") + F.col("_rank") - F.col("_at.low")).alias("slot"))

    # the others fill the free places, one shard after the other
    free = [room[s] - load[s] for s in range(n_shards)]
    low, bounds = 0, []
    for s, f in enumerate(free):
        if f > 0:
            bounds.append((low, low + f, s, load[s]))
        low += max(0, f)
    alone = base.join(state.select(F.col("g").alias("_group")).distinct(), "_group", "left_anti")
    if not bounds:
        return first
    ranked = _ranked(alone, [], "_rank")
    list_ = F.array(*(F.struct(F.lit(a).alias("low"), F.lit(b).alias("high"), F.lit(s).alias("shard"), F.lit(m).alias("first")) for a, b, s, m in bounds))
    at = F.filter(list_, lambda p: (p["low"] <= F.col("_rank")) & (F.col("_rank") < p["high"]))[0]
    rest = ranked.withColumn("_at", at).select(*own, F.col("_at.shard").alias("shard"), (F.col("_at.first") + F.col("_rank") - F.col("_at.low")).alias("slot"))
    return first.unionByName(rest)


def _ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Ranks from 0 within keys, any order: by salt, then within the salt, so that no task holds a whole key."""
    by = [*keys, "_salt"]
    part = ", ".join(keys)
    counts = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    over = f"OVER ({'PARTITION BY ' + part if part else ''} ORDER BY _salt)"
    counts = counts.withColumn("_ahead", F.expr(f"sum(_n) {over} - _n")).drop("_n")
    inner = F.expr(f"row_number() OVER (PARTITION BY {', '.join(by)} ORDER BY _row) - 1")
    return rows.withColumn("_in", inner).join(counts, by).withColumn(name, F.col("_ahead") + F.col("_in")).drop("_in", "_ahead")
