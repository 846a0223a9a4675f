"""Provenance: licences, manifests, pack resolution, links of pages, governance gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spritelake.functions.rules import first_match
from spritelake.operators import ordering

# What an acceptable licence's text contains, and what it must not.
ACCEPTED = ("cc0", "cc-by", "cc-by-sa", "cc0-1.0", "cc-by-4.0", "cc-by-3.0", "cc-by-sa-4.0", "cc-by-sa-3.0", "publicdomain", "public domain")
REFUSED = ("nc", "nd")
VERIFIED = ("CC0", "CC-BY", "CC-BY-SA")


def accepted(text: Column, strict_words: bool = False) -> Column:
    """Whether a licence text is acceptable. As published, 'nc' and 'nd' refuse anywhere, even in
    'licence' and 'and'; with ``strict_words`` only as words of their own."""
    low = F.lower(F.trim(text))
    refused = low.rlike(r"(^|[^a-z])(nc|nd)([^a-z]|$)") if strict_words else low.rlike("|".join(REFUSED))
    return F.coalesce(~refused & low.rlike("|".join(a.replace(".", r"\.") for a in ACCEPTED)), F.lit(False))


def verified(license_id: Column) -> Column:
    return F.coalesce(license_id.isin(*VERIFIED), F.lit(False))


def license_url(license_id: Column) -> Column:
    low = F.lower(license_id)
    return first_match(
        [
            (low.contains("cc0"), F.lit("https://creativecommons.org/publicdomain/zero/1.0/")),
            (low.contains("cc-by-sa"), F.lit("https://creativecommons.org/licenses/by-sa/4.0/")),
            (low.contains("cc-by"), F.lit("https://creativecommons.org/licenses/by/4.0/")),
        ],
        F.lit(""),
    )


def source_info(path: Column) -> Column:
    """A struct (creator, license, url) by the folders of a path."""
    parts, low = F.split(path, "/"), F.lower(path)
    # Creators, licences and their addresses.
    urls = {"CC0": "https://creativecommons.org/publicdomain/zero/1.0/", "CC-BY-SA": "https://creativecommons.org/licenses/by-sa/3.0/"}

    def info(creator: str, license_id: str, url: str | None = None) -> Column:
        return F.struct(F.lit(creator).alias("creator"), F.lit(license_id).alias("license"), F.lit(urls[license_id] if url is None else url).alias("url"))

    oga = F.array_contains(parts, "opengameart")
    return first_match(
        [
            (F.array_contains(parts, "kenney"), info("Kenney.nl", "CC0")),
            (oga & low.rlike("lpc|zelda_like"), info("OpenGameArt (LPC)", "CC-BY-SA")),
            (oga & low.contains("dungeon_crawl"), info("Dungeon Crawl Stone Soup", "CC0")),
            (oga, info("OpenGameArt contributor", "CC0")),
            (F.array_contains(parts, "direct") | low.contains("lpc"), info("LPC Community", "CC-BY-SA")),
        ],
        info("Unknown", "CC0", ""),
    )


def slug(text: Column, most: int = 60) -> Column:
    return F.substring(F.regexp_replace(F.lower(text), "[^a-z0-9_]", "_"), 1, most)


def safe_stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"\.[^./]*$", ""), "/", "__"), " ", "_")


def pack_of(path: Column, parent: Column | None = None) -> Column:
    """The first folder of a path; for a bare name, ``parent`` where it is given."""
    first = F.get(F.split(path, "/"), 0)
    return first if parent is None else F.when(path.contains("/"), first).otherwise(parent)


def without_prefix(path: Column, prefix: str) -> Column:
    return F.when(path.startswith(prefix), F.substring(path, F.lit(len(prefix) + 1), F.length(path))).otherwise(path)


def missing_from(found: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """What is on disk but not in the manifest."""
    return found.join(manifest.select(key).distinct(), key, "left_anti")


def in_manifest(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """``rows`` with in_manifest, by an outer join with distinct keys."""
    known = manifest.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("in_manifest", F.lit(True))
    return rows.join(known, key, "left").withColumn("in_manifest", F.coalesce("in_manifest", F.lit(False)))


def with_sibling(files: DataFrame, folder: str, test: Column, name: str) -> DataFrame:
    """``files`` with ``name``: whether the same folder has a file that passes ``test``. The folders
    are made distinct before they are joined; a null folder has no siblings."""
    have = files.filter(test).select(folder).distinct().withColumn("__has", F.lit(True))
    return files.join(have, folder, "left").withColumn(name, F.coalesce("__has", F.lit(False))).drop("__has")


def zipped(left: DataFrame, right: DataFrame, sheet: str, left_order: str, right_order: str) -> DataFrame:
    """Rows of both tables with the same place (from 1) in their orders within a sheet; what one of
    them has more of is left out, as when two lists are zipped."""
    a, b = ordering.running(left, [left_order], {}, (sheet,)), ordering.running(right, [right_order], {}, (sheet,))
    return a.join(b, [sheet, "place"])


def resolved_packs(packs: DataFrame, catalogue: DataFrame, searched: DataFrame | None = None, bounded_by: int = 10_000) -> DataFrame:
    """``packs`` (source, pack) with creator, license, how and reason: the catalogue first, then what
    the sources' policies say, then ``searched`` (pack, creator, license, verified: what the pages
    found for open packs said), else quarantine with a reason. Both tables are broadcast if small."""
    spark = packs.sparkSession
    if searched is None:
        searched = spark.createDataFrame([], "pack string, creator string, license string, verified boolean")
    known = catalogue.select("source", "pack", F.col("creator").alias("__creator"), F.col("license").alias("__license"))
    pages = searched.select("pack", F.col("creator").alias("__page_creator"), F.col("license").alias("__page_license"), F.coalesce("verified", F.lit(False)).alias("__verified"))
    known, pages = (F.broadcast(t) if t.limit(bounded_by + 1).count() <= bounded_by else t for t in (known, pages))
    rows = packs.join(known, ["source", "pack"], "left").join(pages, "pack", "left")
    hit, kenney, lpc = F.col("__license").isNotNull(), F.col("source") == "kenney", (F.col("source") == "direct") & (F.col("pack") == "lpc_base")
    found = (F.col("source") == "opengameart") & F.col("__verified").isNotNull()
    proven = F.col("__verified") & F.col("__page_license").isNotNull()
    fits = proven & accepted(F.col("__page_license"))
    how = first_match([(hit, F.lit("known")), (kenney, F.lit("inferred")), (lpc, F.lit("lpc_base")), (found & fits, F.lit("searched"))], F.lit("quarantine"))
    why = first_match([(found & ~proven, F.lit("license unverifiable")), (found & ~fits, F.lit("license not acceptable"))], F.lit("no provenance"))
    rows = rows.withColumn("how", how)
    return rows.withColumns({
        "reason": F.when(F.col("how") == "quarantine", why),
        "creator": first_match([(hit, F.col("__creator")), (kenney, F.lit("Kenney")), (lpc, F.lit("LPC Community")), (F.col("how") == "searched", F.col("__page_creator"))], F.lit(None)),
        "license": first_match([(hit, F.col("__license")), (kenney, F.lit("CC0")), (lpc, F.lit("CC-BY-SA")), (F.col("how") == "searched", F.col("__page_license"))], F.lit(None)),
    }).drop("__creator", "__license", "__page_creator", "__page_license", "__verified")


HREF = r'href="([^"]*)"'


def links(pages: DataFrame, per_page: int, pattern: str = HREF, ending: str | None = None, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, place, link): the first distinct links of each page. Distinct and first N are array
    operations of the page's row, so nothing is shuffled."""
    found = F.array_distinct(F.regexp_extract_all(F.col(html_col), F.lit(pattern), F.lit(1)))
    if ending:
        found = F.filter(found, lambda u: u.rlike(ending))
    first = F.slice(found, F.lit(1), F.lit(per_page))
    return pages.select(F.col(id_col).alias("id"), F.posexplode(first).alias("place", "link"))


def listing(pages: DataFrame, number: Column, most: int, visited: DataFrame | None = None, pattern: str = HREF, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(link): the first ``most`` distinct links of a paginated listing, in order of page and place,
    up to its first page without a link; links in ``visited`` are left out. Which page is the first
    empty one is an aggregate, so pages are read at once and not one after the other."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(pattern), F.lit(1))
    rows = pages.select(number.alias("number"), F.col(id_col).alias("id"), found.alias("found"))
    counts = rows.groupBy("number").agg(F.sum(F.size("found")).alias("n"))
    stop = counts.agg(F.min(F.when(F.col("n") == 0, F.col("number"))).alias("stop"))  # one row
    kept = rows.crossJoin(F.broadcast(stop)).filter("stop IS NULL OR number < stop")
    links = kept.select("number", "id", F.posexplode("found").alias("place", "link"))
    first = links.groupBy("link").agg(F.min(F.struct("number", "id", "place")).alias("at"))
    if visited is not None:
        first = first.join(visited.select("link").distinct(), "link", "left_anti")
    return first.orderBy("at", "link").limit(most).select("link")


def first_link(html: Column, pattern: str = r"""href=["']([^"']+\.zip)["']""", base: str | None = None) -> Column:
    """The first link that fits, made absolute; null without one."""
    found = F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    return found if base is None else F.when(found.rlike("^https?://"), found).otherwise(F.concat(F.lit(base), found))


def first_text(html: Column, patterns: list[str], otherwise: str = "Unknown") -> Column:
    """The first of several patterns that finds a non-empty text."""
    return F.coalesce(*(F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit("")) for p in patterns), F.lit(otherwise))


def clean_title(title: Column, most: int = 40) -> Column:
    return F.trim(F.substring(F.regexp_replace(title, r"\s*\|.*$", ""), 1, most))


def lock_confirmed(character: Column, text: Column) -> Column:
    """Whether a text confirms the lock of a character, letter for letter."""
    return F.coalesce(F.trim(text) == F.concat(F.lit("CONFIRM LOCK "), character), F.lit(False))


def phase_gate(criteria: DataFrame, met: str = "met", blocker: str = "blocker") -> DataFrame:
    """One row (passed): no blockers, and every criterion is met."""
    return criteria.agg((F.coalesce(F.bool_and(met), F.lit(True)) & ~F.coalesce(F.bool_or(blocker), F.lit(False))).alias("passed"))


def training_gate(manifest: DataFrame, notes_exist: bool, approval_text: str, marker: str = "PHASE4_ARCHITECTURE_REVIEW: APPROVED") -> bool:
    """Notes, an approval and a manifest with an entry."""
    return notes_exist and marker in approval_text and not manifest.isEmpty()


def collision_names(rows: DataFrame, name: str, id_col: str, order: Column) -> DataFrame:
    """``rows`` with golden_name: later rows of one name get six characters of their id."""
    at = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return rows.withColumn("golden_name", F.when(at == 1, F.col(name)).otherwise(F.concat_ws("_", name, F.substring(F.col(id_col).cast("string"), 1, 6))))
