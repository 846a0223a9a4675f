"""Ordered rule tables, compiled to CASE expressions: the first rule that fits decides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first rule whose condition holds."""
    out = otherwise
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row. The optimiser writes an expression out at each
    of its uses, above all where a filter moves below a projection; a lambda's variable stays one, and
    its rules are no generated method too long for the JVM to compile."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Patterns are searched for in the lower-cased "pack/path"; the first that is found
# decides. (pattern, class, subclass, confidence, rule)
CLASS_RULES: list[tuple[str, str, str | None, float, str]] = [
    ("dungeoncrawl|projectutumno|dcss|crawl.*tile|oga.*dungeon", "tileset", "dungeon", 0.90, "pack_keyword:dungeon_crawl"),
    ("lpc.*base.*tile|lpc.*castle|lpc.*dungeon|lpc.*floor|lpc.*wall|lpc.*stair|lpc.*mountain|lpc.*cabinet|lpc.*interior|castlefloor|castlewall|castle_outside", "tileset", "structure", 0.90, "pack_keyword:lpc_tileset"),
    ("lpc.*tree|lpc.*plant|lpc.*rock|lpc.*treetop", "environment", "tree", 0.85, "pack_keyword:lpc_environment"),
    ("lpc.*character|lpc.*char|lpc.*human|lpc.*npc", "character", "humanoid", 0.85, "pack_keyword:lpc_character"),
    ("kenney.*medieval.*rts|medieval(environment|structure|tile|unit|prop|weapon|ruin)", "tileset", "exterior", 0.88, "pack_keyword:kenney_medieval_tile"),
    (r"kenney.*rpg.*urban|rpg.*urban.*pack|rpgtile\d+", "tileset", "interior", 0.85, "pack_keyword:kenney_rpg_urban"),
    ("kenney.*tiny.*town|tiny.*town", "tileset", "exterior", 0.85, "pack_keyword:kenney_tiny_town"),
    ("kenney.*pixel.*platformer.*background", "environment", "structure", 0.80, "pack_keyword:kenney_platformer_bg"),
    ("kenney.*pixel.*platformer", "tileset", "terrain", 0.85, "pack_keyword:kenney_platformer_tile"),
    ("kenney.*roguelike|micro.*roguelike", "tileset", "dungeon", 0.82, "pack_keyword:kenney_roguelike"),
    ("kenney.*1.*bit", "tileset", "terrain", 0.75, "pack_keyword:kenney_1bit"),
    ("kenney.*vehicle|kenney.*car|kenney.*ship|kenney.*plane", "vehicle", None, 0.90, "pack_keyword:kenney_vehicle"),
    ("kenney.*ui|kenney.*button|kenney.*cursor|kenney.*hud", "ui", "button", 0.90, "pack_keyword:kenney_ui"),
    ("kenney.*icon", "ui", "icon", 0.90, "pack_keyword:kenney_icon"),
    ("kenney.*item|kenney.*weapon|kenney.*sword|kenney.*chest|kenney.*coin|kenney.*gem", "item", None, 0.85, "pack_keyword:kenney_item"),
    ("kenney.*character|kenney.*player|kenney.*hero|kenney.*npc|kenney.*person", "character", "humanoid", 0.85, "pack_keyword:kenney_character"),
    ("kenney.*enemy|kenney.*monster|kenney.*creature|kenney.*alien", "character", "monster", 0.85, "pack_keyword:kenney_enemy"),
    ("kenney.*effect|kenney.*particle|kenney.*explosion|kenney.*magic", "effect", None, 0.85, "pack_keyword:kenney_effect"),
    ("/characters?/|/char/|/heroes?/|/player/|/npc/|/enemies?/|/monsters?/", "character", "humanoid", 0.80, "path_keyword:characters"),
    ("/tiles?/|/terrain/|/map/|/tileset/|/floors?/|/walls?/|/grounds?/", "tileset", "terrain", 0.80, "path_keyword:tiles"),
    ("/ui/|/hud/|/interface/|/buttons?/|/icons?/|/panels?/|/menus?/", "ui", "button", 0.80, "path_keyword:ui"),
    ("/effects?/|/particles?/|/explosions?/|/magic/|/spells?/|/projectiles?/", "effect", "particle", 0.80, "path_keyword:effects"),
    ("/items?/|/weapons?/|/swords?/|/armor/|/armour/|/shields?/|/potions?/|/keys?/|/chests?/", "item", "weapon", 0.80, "path_keyword:items"),
    ("/vehicles?/|/cars?/|/ships?/|/planes?/|/aircraft/", "vehicle", None, 0.80, "path_keyword:vehicles"),
    ("/environments?/|/nature/|/trees?/|/rocks?/|/plants?/|/props?/", "environment", "prop", 0.75, "path_keyword:environment"),
    ("/backgrounds?/|/bg/", "environment", "structure", 0.70, "path_keyword:background"),
    ("character|warrior|knight|mage|wizard|archer|rogue|thief|hero|player|enemy|monster|creature|beast|dragon|goblin|orc|troll|zombie|ghost|demon|angel|fairy|elf|dwarf|human|person|npc|mob", "character", None, 0.72, "pack_keyword:character"),
    ("walk|run|idle|attack|death|hurt|jump|cast|spell|anim", "character", None, 0.68, "pack_keyword:animation"),
    ("floor|wall|ground|terrain|tile|dungeon|cave|castle|interior|exterior|overworld|world|map|room|corridor", "tileset", None, 0.72, "pack_keyword:tileset"),
    ("tree|forest|grass|plant|rock|stone|mountain|river|lake|water|cloud|bush|flower|nature|outdoor", "environment", None, 0.70, "pack_keyword:environment"),
    ("explosion|fire|flame|smoke|spark|particle|magic|glow|lightning|bolt|beam|wave|effect|impact", "effect", None, 0.70, "pack_keyword:effect"),
    ("sword|axe|spear|bow|gun|wand|staff|shield|armor|armour|helmet|potion|scroll|key|coin|gem|treasure|chest|item|loot", "item", None, 0.70, "pack_keyword:item"),
    ("car|truck|ship|boat|plane|aircraft|helicopter|rocket|tank|vehicle|mech", "vehicle", None, 0.70, "pack_keyword:vehicle"),
    ("button|icon|cursor|hud|menu|panel|bar|frame|window|ui|interface", "ui", None, 0.70, "pack_keyword:ui"),
    ("arkanos", "character", "monster", 0.82, "pack_keyword:arkanos_monsters"),
    (r"holek|preview_\d+", "character", "humanoid", 0.70, "pack_keyword:misc_character"),
    ("simples_pimples|simple.*pimple", "character", "creature", 0.70, "pack_keyword:simples_pimples"),
    ("rpg.*pack|rpg.*asset|rpg.*sprite", "character", None, 0.65, "pack_keyword:rpg_generic"),
]

# Where a class rule names no subclass, the first of these that is found gives it.
SUBCLASS_RULES: dict[str, list[tuple[str, str]]] = {
    "character": [
        ("human|person|npc|villager|civilian|townsperson|blonde|black|grey|red|brown", "humanoid"),
        ("monster|enemy|mob|boss|demon|orc|goblin|troll|zombie|undead|ghost|vampire", "monster"),
        ("creature|beast|dragon|wolf|cat|dog|bird|fish|insect|slime|worm|spider", "creature"),
        ("npc|merchant|shopkeeper|guard|soldier|knight|king|queen|wizard|mage", "npc"),
    ],
    "tileset": [
        ("dungeon|cave|underground|crypt|sewer", "dungeon"),
        ("castle|fort|wall|tower|battlement|stone|brick", "structure"),
        ("indoor|interior|inside|room|floor|carpet|wood", "interior"),
        ("outdoor|exterior|outside|street|road|path", "exterior"),
        ("grass|sand|dirt|snow|lava|water|rock|terrain|ground", "terrain"),
    ],
    "environment": [
        ("tree|forest|bush|shrub|log|stump", "tree"),
        ("rock|stone|boulder|cliff|mountain", "rock"),
        ("plant|flower|mushroom|cactus|seaweed", "plant"),
        ("water|lake|river|ocean|puddle|waterfall", "water"),
        ("building|house|shop|ruin|wall|structure", "structure"),
    ],
    "effect": [
        ("particle|spark|dust|smoke|steam", "particle"),
        ("projectile|bullet|arrow|bolt|missile|shot", "projectile"),
        ("explosion|blast|boom|burst", "explosion"),
        ("magic|spell|cast|glow|beam|wave|lightning", "magic"),
        ("rain|snow|fog|cloud|weather", "weather"),
    ],
    "item": [
        ("sword|axe|spear|bow|gun|wand|staff|dagger|blade|weapon", "weapon"),
        ("armor|armour|shield|helmet|boots|glove|cloak|robe", "armor"),
        ("potion|food|herb|berry|mushroom|consumable", "consumable"),
        ("key|door|lock|lever|switch", "key_item"),
        ("coin|gem|gold|treasure|chest|ring|amulet", "treasure"),
    ],
    "vehicle": [
        ("car|truck|cart|horse|bike|cycle", "ground"),
        ("plane|aircraft|helicopter|balloon|rocket|ship.*air|airship", "air"),
        ("boat|ship|canoe|raft|sub|naval", "water"),
        ("rocket|ufo|shuttle|space.*ship", "space"),
    ],
    "ui": [
        ("button|btn|click|press", "button"),
        ("icon|symbol|badge|emblem", "icon"),
        ("panel|window|frame|border|box", "panel"),
        ("cursor|pointer|arrow.*ui|crosshair", "cursor"),
        ("hud|health|mana|bar|status|gauge", "hud"),
    ],
}

# Aesthetic style of a pack, by the same machinery.
STYLE_RULES: list[tuple[str, str]] = [
    ("kenney.*medieval.*rts", "snes_jrpg"),
    ("lpc.*base", "snes_jrpg"),
    ("kenney.*1.*bit", "monochrome"),
    ("kenney.*platformer", "snes_platformer"),
    ("modern.*indie", "modern_indie"),
]


def searched(pack: Column, path: Column) -> Column:
    return F.lower(F.concat(pack, F.lit("/"), path))


def class_label(pack: Column, path: Column, has_tileset_meta: Column) -> Column:
    """A struct (sprite_class, sprite_subclass, class_confidence, class_rule_matched)."""

    def label(cls: str, sub: Column, confidence: float, rule: str) -> Column:
        return F.struct(
            F.lit(cls).alias("sprite_class"), sub.cast("string").alias("sprite_subclass"),
            F.lit(confidence).cast("double").alias("class_confidence"), F.lit(rule).alias("class_rule_matched"),
        )

    nothing = F.lit(None).cast("string")

    def labelled(text: Column) -> Column:
        rules = [(has_tileset_meta, label("tileset", nothing, 0.95, "tileset_meta_present"))]
        for pattern, cls, sub, confidence, rule in CLASS_RULES:
            refined = F.lit(sub) if sub else first_match([(text.rlike(p), F.lit(n)) for p, n in SUBCLASS_RULES.get(cls, [])], nothing)
            rules.append((text.rlike(pattern), label(cls, refined, confidence, rule)))
        return first_match(rules, label("unknown", nothing, 0.0, "no_rule_matched"))

    return let(searched(pack, path), labelled)


def aesthetic_style(pack: Column) -> Column:
    return let(F.lower(pack), lambda low: first_match([(low.rlike(p), F.lit(s)) for p, s in STYLE_RULES], F.lit("unknown")))


def asset_rubric(asset_type: Column) -> Column:
    """A struct (rubric, is_effect) by asset type; rubric A where nothing fits."""
    low = F.lower(asset_type)

    def rubric(letter: str, effect: Column) -> Column:
        return F.struct(F.lit(letter).alias("rubric"), effect.alias("is_effect"))

    return first_match(
        [
            (low.rlike("character|enemy|npc|portrait|effect|boss"), rubric("A", low.contains("effect"))),
            (low.contains("tile"), rubric("B", F.lit(False))),
            (low.rlike("parallax|background"), rubric("C", F.lit(False))),
        ],
        rubric("A", F.lit(False)),
    )
