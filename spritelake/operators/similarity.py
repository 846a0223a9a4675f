"""Similar sprites: palette overlap pairs, sheet types, perceptual hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SIMILAR = 0.6
LEAST_SHEET_SPRITES, SAMPLED_SPRITES, SAMPLED_PAIRS = 20, 24, 12
HIGH, LOW = 0.70, 0.45
DECIDED = 0.30
# Of palettes compared as bits: 64-bit numbers a sprite, sprites a tile.
WORDS, TILE = 4, 1000

# Words of a sheet's name that speak for characters or for tilesets.
CHARACTER_WORDS = [
    "character", "char", "hero", "player", "enemy", "npc", "monster", "walk", "run", "idle", "attack", "death", "hurt", "jump", "fall",
    "sprite_sheet", "anim", "animation", "warrior", "mage", "knight", "boss", "mob", "creature", "humanoid", "person", "figure",
]
TILESET_WORDS = [
    "tile", "tileset", "tilemap", "terrain", "map", "floor", "wall", "ground", "dungeon", "overworld", "world", "environment", "env", "grass",
    "water", "stone", "rock", "sand", "dirt", "cave", "forest", "field", "road", "path", "indoor", "outdoor", "platform", "block", "brick", "wood",
    "metal", "ice", "lava",
]


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 0 where both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), F.size(a) + F.size(b) - both), F.lit(0.0))


def similar_pairs(sprites: DataFrame, block: list[str], id_col: str = "sprite_id", palette_col: str = "palette", least: float = SIMILAR) -> DataFrame:
    """(id_a, id_b, similarity, block) of all pairs of a block whose palettes overlap enough.

    Blocks whose colours are many go through a prefix filter: with palettes in one order (rarest
    colour of the block first), a pair that reaches ``least`` shares a colour among the first
    n - ceil(least * n) + 1 of each, and the smaller has at least ``least`` times the size of the
    larger. Sprites meet by an equality join on (block, prefix colour); where the colour stands in both
    bounds what they can still share, and only candidates within that bound are compared.

    In a block of few colours most pairs meet there, several times each. Where the prefix would bring
    together as many pairs as the block has, its sprites are dealt into tiles and each pair of tiles is
    compared once: the block's 256 most used colours are bits of four numbers, so a pair costs four
    bit counts. Other colours are compared as arrays, where the bits leave enough. Both ways are exact.

    Rows of one id with different palettes are sprites of their own; equal rows count once."""
    rows = sprites.select(F.col(id_col).alias("id"), *block, F.array_distinct(palette_col).alias("p")).filter(F.size("p") > 0)
    rows = rows.withColumn("whole", F.array_sort("p"))
    uses = rows.select(*block, F.explode("p").alias("c")).groupBy(*block, "c").agg(F.count("*").alias("uses"))
    # The window takes a row for each colour of a block; Spark keeps 256 of them before it shuffles.
    rank = F.row_number().over(Window.partitionBy(*block).orderBy(F.desc("uses"), "c"))
    bits = uses.withColumn("bit", rank - 1).filter(F.col("bit") < 64 * WORDS).select(*block, "c", "bit")
    uses = _with(uses, bits, [*block, "c"], "left")
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("bit") / 64) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")))), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)]
    entry = F.struct("uses", "c")
    ordered = _with(rows.select("id", *block, "whole", F.explode("p").alias("c")).distinct(), uses, [*block, "c"], "inner").groupBy("id", *block, "whole")
    ordered = ordered.agg(F.sort_array(F.collect_list(entry)).alias("s"), F.collect_list(F.when(F.col("bit").isNull(), F.col("c"))).alias("rest"), *words)
    ordered = ordered.withColumn("p", F.transform("s", lambda x: x["c"]))
    n = F.size("p")
    prefix = F.slice("p", F.lit(1), (n - F.ceil(n * least - 1e-9).cast("int") + 1).cast("int"))
    met = ordered.select(*block, F.explode(prefix).alias("c")).groupBy(*block, "c").agg(F.count("*").cast("double").alias("f"))
    met = met.groupBy(*block).agg(F.sum(F.col("f") * (F.col("f") - 1)).alias("met"))
    sizes = ordered.groupBy(*block).agg(F.count("*").alias("sprites"))
    plan = _with(sizes, met, block, "inner").select(*block, "sprites", (F.col("met") >= F.col("sprites").cast("double") * (F.col("sprites") - 1)).alias("dense"))
    ordered = _with(ordered, plan, block, "inner")
    few, many = (ordered.filter(c) for c in (F.col("dense"), ~F.col("dense")))
    return _tiled(few, block, least).union(_prefixed(many.withColumn("prefix", prefix), block, least))


def _with(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which null keys are equal; columns of the left, then those of the right."""
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    more = [F.col(f"b.{c}").alias(c) for c in b.columns if c not in keys]
    return a.alias("a").join(b.alias("b"), on, how).select(*(F.col(f"a.{c}").alias(c) for c in a.columns), *more)


def _tiled(rows: DataFrame, block: list[str], least: float) -> DataFrame:
    """Pairs of blocks that are compared whole. A tile has about TILE sprites; a pair of tiles is one key,
    so what a task holds is bounded, and the keys of a hot block are dealt to all tasks."""
    tiles = F.ceil(F.col("sprites") / TILE)
    rows = rows.select("id", *block, F.size("p").alias("n"), "rest", *(f"w{k}" for k in range(WORDS)), tiles.alias("tiles"), F.pmod(F.xxhash64("id", "whole"), tiles).alias("tile"))
    keys = [*block, "t", "u"]
    a = rows.select("*", F.col("tile").alias("t"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("u"))
    b = rows.select("*", F.col("tile").alias("u"), F.explode(F.sequence(F.lit(0).cast("long"), "tile")).alias("t"))
    dealt = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: little data, much work
    a, b = (x.drop("tile", "tiles").repartition(dealt, *keys) for x in (a, b))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    shared = sum((F.bit_count(F.col(f"a.w{k}").bitwiseAND(F.col(f"b.w{k}"))) for k in range(1, WORDS)), F.bit_count(F.col("a.w0").bitwiseAND(F.col("b.w0"))))
    whole = F.col("a.n") + F.col("b.n")
    most = shared + F.least(F.size("a.rest"), F.size("b.rest"))
    once = (F.col("a.t") < F.col("a.u")) & (F.col("a.id") != F.col("b.id")) | (F.col("a.id") < F.col("b.id"))
    met = a.alias("a").join(b.alias("b").hint("merge"), [*on, most * F.lit(1 + least) >= F.lit(least) * whole - 1e-9, once])
    rest = F.when((F.size("a.rest") > 0) & (F.size("b.rest") > 0), F.size(F.array_intersect("a.rest", "b.rest"))).otherwise(0)
    both = (shared + rest).cast("double")
    found = met.select(F.least("a.id", "b.id").alias("id_a"), F.greatest("a.id", "b.id").alias("id_b"), (both / (whole - both)).alias("similarity"), *(F.col(f"a.{k}").alias(k) for k in block))
    return found.filter(F.col("similarity") >= least)


def _prefixed(rows: DataFrame, block: list[str], least: float) -> DataFrame:
    """Pairs of blocks whose sprites meet at colours of their prefixes."""
    keyed = rows.select("id", *block, "p", F.posexplode("prefix").alias("at", "c"))
    a, b = keyed.alias("a"), keyed.alias("b").hint("merge")  # exploded rows are more than the planner expects
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in block] + [F.col("a.c") == F.col("b.c"), F.col("a.id") < F.col("b.id")]
    sizes = F.least(F.size("a.p"), F.size("b.p")) >= F.greatest(F.size("a.p"), F.size("b.p")) * F.lit(least) - 1e-9
    # From this colour on, the first that both have, they share at most what is left of either.
    left = F.least(F.size("a.p") - F.col("a.at"), F.size("b.p") - F.col("b.at"))
    enough = left * F.lit(1 + least) >= F.lit(least) * (F.size("a.p") + F.size("b.p")) - 1e-9
    met = a.join(b, on).filter(sizes & enough)
    # A pair that shares several prefix colours is kept at the first one only; an intersection of
    # two arrays in one order begins with it.
    met = met.filter(F.get(F.array_intersect("a.p", "b.p"), 0) == F.col("a.c"))
    found = met.select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), jaccard(F.col("a.p"), F.col("b.p")).alias("similarity"), *(F.col(f"a.{k}").alias(k) for k in block))
    return found.filter(F.col("similarity") >= least)


def mean_overlap(sprites: DataFrame, sheet: str = "sheet", id_col: str = "sprite_id", palette_col: str = "palette") -> DataFrame:
    """(sheet, overlap): mean palette overlap of at most 12 pairs, chosen by a hash, of the sheet's
    first 24 sprites; null with fewer than two palettes. Bounded by these two limits, which are
    the feature."""
    first = Window.partitionBy(sheet).orderBy("id")
    kept = sprites.filter(F.size(palette_col) > 0).select(sheet, F.col(id_col).alias("id"), F.col(palette_col).alias("p"))
    kept = kept.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= SAMPLED_SPRITES)
    a, b = kept.alias("a"), kept.alias("b")
    pairs = a.join(b, (F.col(f"a.{sheet}") == F.col(f"b.{sheet}")) & (F.col("a.k") < F.col("b.k")))
    key = F.md5(F.concat_ws(":", F.lit("42"), F.col("a.id").cast("string"), F.col("b.id").cast("string")))
    pairs = pairs.select(F.col(f"a.{sheet}").alias(sheet), key.alias("key"), jaccard(F.col("a.p"), F.col("b.p")).alias("j"))
    chosen = pairs.withColumn("r", F.row_number().over(Window.partitionBy(sheet).orderBy("key"))).filter(F.col("r") <= SAMPLED_PAIRS)
    return chosen.groupBy(sheet).agg(F.avg("j").alias("overlap"))


def name_hits(name: Column, words: list[str]) -> Column:
    tokens = F.array_distinct(F.split(F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " ")), " "))
    return F.size(F.array_intersect(tokens, F.array(*map(F.lit, words))))


def sheet_type(sprite_count: Column, char_hits: Column, tile_hits: Column, overlap: Column) -> Column:
    """A struct (sheet_type, confidence, normalised): weighted signals, decided beyond 0.3."""
    hits = (char_hits + tile_hits).cast("double")
    words = F.when(char_hits > tile_hits, 2.0 * (char_hits / hits)).when(tile_hits > char_hits, -2.0 * (tile_hits / hits)).otherwise(0.0)
    count = F.when(sprite_count >= LEAST_SHEET_SPRITES, -1.5).otherwise(0.5)
    t = (overlap - LOW) / F.lit(HIGH - LOW)
    shared = F.when(overlap.isNull(), 0.0).when(overlap >= HIGH, 2.5).when(overlap <= LOW, -2.5).otherwise(2.5 * (2 * t - 1))
    weight = F.when(hits > 0, 2.0).otherwise(0.0) + 1.5 + F.when(overlap.isNotNull(), 2.5).otherwise(0.0)
    n = (words + count + shared) / weight
    kind = F.when(n >= DECIDED, "character").when(n <= -DECIDED, "tileset").otherwise("ambiguous")
    confidence = F.when(F.abs(n) >= DECIDED, F.least(F.abs(n), F.lit(1.0))).otherwise(1.0 - F.abs(n) / DECIDED)
    return F.struct(kind.alias("sheet_type"), F.round(confidence, 4).alias("confidence"), F.round(n, 4).alias("normalised"))


def hash_pairs(hashes: DataFrame, id_col: str, hash_col: str, within: int = 3) -> DataFrame:
    """(id_a, id_b, distance): pairs of 16-digit hashes at most ``within`` bits apart.

    A hash is cut into within // 2 + 1 segments, so in one of them a pair differs by at most one
    bit. One side files each segment as it is, the other as it is and once for each of its bits, with
    that bit turned: pairs meet by an equality join, at the first such segment only, and are verified
    by their bits. Distinct hashes are compared; ids are joined to the pairs that are found, and equal
    hashes are pairs as well. A radius whose segments would have fewer than 16 bits is refused: such
    keys would bring together a share of all pairs.

    The join is a merge by hint: the planner takes the exploded side for as small as the hashes before
    it and would send it to the driver as a broadcast. The hashes are dealt anew before, as one
    partition of hashes is many of segments."""
    n = within // 2 + 1
    if 64 // n < 16:
        raise ValueError("no selective key for so wide a radius")
    half = [F.conv(F.substring(hash_col, at, 8), 16, 10).cast("long") for at in (1, 9)]
    rows = hashes.select(F.col(id_col).alias("id"), F.shiftleft(half[0], 32).bitwiseOR(half[1]).alias("h"))
    cuts = [(64 * k // n, 64 * (k + 1) // n - 64 * k // n) for k in range(n)]

    def segment(h: Column, k: int) -> Column:
        return F.shiftrightunsigned(h, cuts[k][0]).bitwiseAND(F.lit((1 << cuts[k][1]) - 1)) if n > 1 else h

    own_key = [segment(F.col("h"), k).bitwiseOR(F.lit(k << 32)) for k in range(n)]
    turned = [own_key[k].bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for k in range(n) for i in range(cuts[k][1])]
    each = rows.select("h").distinct()
    dealt = each.repartition(int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "h")
    a = dealt.select("h", F.explode(F.array(*own_key, *turned)).alias("key")).alias("a")
    b = dealt.select("h", F.explode(F.array(*own_key)).alias("key")).alias("b")
    xor = F.col("a.h").bitwiseXOR(F.col("b.h"))
    first = F.coalesce(*(F.when(F.bit_count(segment(xor, k)) <= 1, k) for k in range(n)))
    met_at = F.shiftrightunsigned("a.key", 32) if n > 1 else F.lit(0)
    near = a.join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & (F.col("a.h") < F.col("b.h")) & (F.bit_count(xor) <= within) & (first == met_at))
    near = near.select(F.col("a.h").alias("x"), F.col("b.h").alias("y"), F.bit_count(xor).alias("distance"))
    own = each.select(F.col("h").alias("x"), F.col("h").alias("y"), F.lit(0).alias("distance"))
    left, right = rows.select(F.col("id").alias("i"), F.col("h").alias("x")), rows.select(F.col("id").alias("j"), F.col("h").alias("y"))
    met = near.union(own).join(left, "x").join(right, "y").filter((F.col("x") != F.col("y")) | (F.col("i") < F.col("j")))
    return met.select(F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b"), "distance").filter("id_a < id_b").distinct()
