"""Entity resolution as set-based joins: golden records, blocking, identifiers, fills."""

from __future__ import annotations

import uuid
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import reduce
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyframe.functions.text import match_key, normalize_latin, romanize, similarity, slug
from tallyframe.sources.shared import delete_at_exit, release, reliable, shared_folder, tabled

from .graph import contract
from .ranking import global_rank


def content_id(prefix: str, *parts: Column) -> Column:
    """PREFIX- and the first 12 digits of SHA-1 over the parts joined by '|'; a null part is empty."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha1(joined.cast("binary")), 1, 12))


def golden_record(rows: DataFrame, key: list[str], fields: list[str], priority: str, seq: str) -> DataFrame:
    """For each field the non-empty value of the most trusted source (smallest priority), the first one among equals."""

    def best(c: str) -> Column:
        filled = F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        return F.min_by(c, F.when(filled, F.struct(priority, seq))).alias(c)

    return rows.groupBy(*key).agg(*[best(c) for c in fields])


def mint_ids(keys: DataFrame, known: DataFrame, key: str, prefix: str, digits: int = 5) -> DataFrame:
    """(key, id): known ids stay, new keys are numbered on from the largest known number, in key order."""
    top = known.agg(F.coalesce(F.max(F.regexp_extract("id", r"(\d+)$", 1).cast("long")), F.lit(0)).alias("top"))
    new = global_rank(keys.select(key).distinct().join(known, key, "left_anti"), [key], "n")
    minted = new.crossJoin(F.broadcast(top)).select(key, F.concat(F.lit(f"{prefix}-"), F.lpad((F.col("top") + F.col("n")).cast("string"), digits, "0")).alias("id"))
    return known.select(key, "id").unionByName(minted)


def fill_blanks(kept: DataFrame, staged: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """kept with its blanks filled from staged rows of the same key, and staged rows of other keys added."""
    s = staged.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    filled = kept.join(s, key, "left").select(key, *[F.coalesce(F.nullif(F.col(f), F.lit("")), F.col(f"_{f}"), F.lit("")).alias(f) for f in fields])
    return filled.unionByName(staged.join(kept, key, "left_anti").select(key, *fields))


def provenance(rows: DataFrame, table: str, key: str, fields: list[str], source: Column) -> DataFrame:
    """One row for each non-empty field: where its value is from, and the value's hash."""
    t = rows.select(F.col(key).cast("string").alias("record_id"), source.alias("source_id"), *[F.col(f).cast("string") for f in fields])
    long = t.unpivot(["record_id", "source_id"], fields, "field_name", "value")
    return long.where("value IS NOT NULL AND value <> ''").select(F.lit(table).alias("table_name"), "record_id", "field_name", "source_id", F.substring(F.sha1(F.col("value").cast("binary")), 1, 12).alias("value_hash"))


def too_far_apart(a_year: Column, b_year: Column, born: Column, most: int = 40) -> Column:
    """Whether two terms lie over `most` years apart; never with a birth date or without a year."""
    return born.isNull() & F.coalesce(F.abs(a_year - b_year) > most, F.lit(False))


#: Rows whose refusals are listed together.
BATCH_ROWS = 1_000


def resolve(rows: DataFrame, sources: list[str], most_years: int = 40, in_order: int | None = None, refusals: bool = True) -> tuple[DataFrame, DataFrame]:
    """(resolved, refused): rows joined to persons, one after another in order of trust of their sources and then of seq.

    rows: source, seq, source_key, ar_key, lat_key (null if unknown), chamber, year, born. A row with the source and source_key of an earlier one is that
    one's person. Else it is held against all rows before it, those of its own source among them, but not those that came by their source_key: it joins
    the person of the first one with its Arabic key or, failing that, its Latin one, that is not of its chamber and not too far apart in time; where the row
    and the person both have a Latin key, an Arabic match must agree with it. Rows that match no one are persons of their own. A person is named by
    the source and seq of the first row, as 'source:seq', and has the first Latin key and birth date that any of its rows brought.

    resolved: source, seq, chamber, person, method, confidence. refused: person, source, seq, chamber_a, chamber_b, years_apart, for each earlier row
    that a row met on its way to its match and that lies too far apart, which may be a good part of all before it; without refusals none are listed. Rows of other sources are left out.

    Rows that share no key never meet: they fall into components, found by contraction, and each component is resolved in order by one task, which reads
    it sorted and holds classes of rows by what is known of their persons, however large it is. Only a caller that names in_order sends components of over so many rows
    through rounds(), where rows of one round do not see each other, so that the results are others.
    """
    known = rows.where(F.col("source").isin(*sources)).select("source", "seq", "source_key", "ar_key", "lat_key", "chamber", "year", "born")
    rank = F.array_position(F.array(*map(F.lit, sources)), F.col("source")).cast("int").alias("rank")
    keys = [F.when(F.col(c).isNotNull(), F.xxhash64(F.lit(c), *([F.col("source")] if c == "source_key" else []), F.col(c))) for c in ("ar_key", "lat_key", "source_key")]
    keyed = tabled(known.select("*", rank, F.array_compact(F.array(*keys)).alias("keys")).withColumn("first", F.coalesce(F.get("keys", F.lit(0)), F.xxhash64("source", "seq"))))
    roots = contract(keyed.select(F.col("first").alias("a"), F.explode("keys").alias("b")))
    placed = tabled(keyed.join(roots, keyed["first"] == roots["node"], "left").withColumn("component", F.coalesce("root", "first")).drop("keys", "first", "node", "root"))
    release(keyed, roots)
    large = tabled(placed.groupBy("component").count().where(F.col("count") > in_order).select("component")) if in_order is not None else None
    turns = tabled(in_turn(placed if large is None else placed.join(F.broadcast(large), "component", "left_anti"), most_years, refusals))
    # The task in order lists a row's refusals beside it, and those who read them make rows of them.
    own = turns.withColumns({"other": F.lit(None).cast(turns.schema["chamber"].dataType), "years_apart": F.lit(None).cast(placed.schema["year"].dataType)}).drop("r_person", "r_chamber", "r_years")
    listed = turns.select("source", "seq", "chamber", F.inline(F.arrays_zip("r_person", "r_chamber", "r_years"))).select(F.col("r_person").alias("person"), "source", "seq", "chamber", F.lit(None).cast("string").alias("method"), F.col("r_chamber").alias("other"), F.col("r_years").alias("years_apart"))
    found = own.unionByName(listed)
    if large is not None and not large.isEmpty():
        found = tabled(found.unionByName(rounds(placed.join(F.broadcast(large), "component", "left_semi"), most_years)))
    release(placed, *([large] if large is not None else []))
    confidence = F.when(F.col("method").isin("source_id", "source_key", "normalised_name_ar+lat"), "high").otherwise("medium").alias("confidence")
    resolved = found.where("method IS NOT NULL").select("source", "seq", "chamber", "person", "method", confidence)
    return resolved, found.where("method IS NULL").select("person", "source", "seq", F.col("other").alias("chamber_a"), F.col("chamber").alias("chamber_b"), "years_apart")


class Person:
    """name, the first Latin key and whether a birth date is known; and, while either may still come, the entries that then change their class."""

    __slots__ = ("name", "lat", "born", "open")

    def __init__(self, name: str):
        self.name, self.lat, self.born, self.open = name, None, False, []


class Refused:
    """Refusals as three lists."""

    def __init__(self):
        self.persons, self.chambers, self.years = [], [], []

    def add(self, persons: list[str], chamber, years: int) -> None:
        self.persons += persons
        self.chambers += [chamber] * len(persons)
        self.years += [years] * len(persons)


class Entries:
    """The rows of one key, as entries (place, person) by chamber, year and what is known of their persons, so that a row looks at classes and not at rows.

    first: by Latin key of the person, then by (chamber, year, born). Of classes whose persons cannot change any more only the first entry is kept. unborn: by
    (chamber, year), those without a birth date, which are refused if they lie too far apart.
    """

    def __init__(self, by_lat: bool):
        self.by_lat = by_lat
        self.first: dict[str | None, dict[tuple, list[tuple]]] = {}
        self.unborn: dict[tuple, tuple[list[int], list[str]]] = {}  # places and names

    def put(self, at: int, person: Person, chamber, year) -> None:
        lat = person.lat if self.by_lat else None
        of = self.first.setdefault(lat, {}).setdefault((chamber, year, person.born), [])
        if person.born and (lat is not None or not self.by_lat):
            if not of or at < of[0][0]:
                of[:] = [(at, person)]
        else:
            insort(of, (at, person), key=itemgetter(0))
        if not person.born:
            ats, names = self.unborn.setdefault((chamber, year), ([], []))
            n = bisect_left(ats, at)
            ats.insert(n, at)
            names.insert(n, person.name)

    def take(self, at: int, person: Person, chamber, year) -> None:
        """The entry leaves, before what is known of its person changes."""
        # A class that keeps its first entry only may have lost this one.
        classes, key = self.first[person.lat if self.by_lat else None], (chamber, year, person.born)
        of = classes.get(key, [])
        n = bisect_left(of, at, key=itemgetter(0))
        if n < len(of) and of[n][0] == at:
            del of[n]
            if not of:
                del classes[key]
        if not person.born:
            ats, names = self.unborn[chamber, year]
            n = bisect_left(ats, at)
            del ats[n], names[n]
            if not ats:
                del self.unborn[chamber, year]

    def hit(self, lat_key, chamber, far: Callable, refused: Refused | None) -> Person | None:
        """The person of the first entry that a row matches; what it meets before and is too far apart goes to refused, if that is asked for."""
        lats = self.first if not self.by_lat or lat_key is None else [x for x in (lat_key, None) if x in self.first]
        best = None
        for lat in lats:
            for (there, then, born), of in self.first[lat].items():
                if there != chamber and (best is None or of[0][0] < best[0]) and (born or not far(then)):
                    best = of[0]
        for (there, then), (ats, names) in self.unborn.items() if refused is not None else ():
            if there != chamber and (years := far(then)):
                refused.add(names if best is None else names[: bisect_left(ats, best[0])], there, years)
        return best[1] if best is not None else None


class Resolver:
    """The rows of one component, in order. What it holds grows with classes of entries and persons of whom not all is known, not with rows."""

    def __init__(self, most_years: int):
        self.most_years, self.count = most_years, 0
        self.by_source_key: dict[tuple, Person] = {}
        self.by_key: dict[tuple, Entries] = {}

    def take(self, source, seq, source_key, ar_key, lat_key, chamber, year, born, more: bool, refused: Refused | None = None) -> tuple[str, str]:
        """(person, method) of the next row, whose refusals are put to refused. more: whether its source_key comes again."""
        person = self.by_source_key.get((source, source_key)) if source_key is not None else None
        if person is not None:
            method = "source_key"
            self._known(person, lat_key, born)
        else:
            person, method = self._by_name(ar_key, lat_key, chamber, year, refused)
            if person is None:
                person, method = Person(f"{source}:{seq}"), "source_id"
            self._known(person, lat_key, born)
            for kind, key in (("ar", ar_key), ("lat", lat_key)):
                if key is not None:
                    entries = self.by_key.get((kind, key))
                    if entries is None:
                        entries = self.by_key[kind, key] = Entries(kind == "ar")
                    entries.put(self.count, person, chamber, year)
                    if person.open is not None:
                        person.open.append((entries, self.count, chamber, year))
            self.count += 1
        if source_key is not None:
            if more:
                self.by_source_key[source, source_key] = person
            else:
                self.by_source_key.pop((source, source_key), None)
        return person.name, method

    def _known(self, person: Person, lat_key, born) -> None:
        lat = lat_key if person.lat is None else person.lat
        born = person.born or born is not None
        if (lat, born) != (person.lat, person.born):
            for entries, at, chamber, year in person.open:
                entries.take(at, person, chamber, year)
            person.lat, was_open, person.born = lat, person.open, born
            for entries, at, chamber, year in was_open:
                entries.put(at, person, chamber, year)
            if lat is not None and born:
                person.open = None

    def _by_name(self, ar_key, lat_key, chamber, year, refused: Refused | None) -> tuple[Person | None, str]:
        def far(then) -> int:
            """How many years lie between, if these are too many."""
            apart = abs(year - then) if year is not None and then is not None else 0
            return apart if apart > self.most_years else 0

        for kind, key in (("ar", ar_key), ("lat", lat_key)):
            entries = self.by_key.get((kind, key)) if key is not None else None
            if entries is not None and (person := entries.hit(lat_key, chamber, far, refused)) is not None:
                return person, "normalised_name_lat" if kind == "lat" else "normalised_name_ar" if lat_key is None or person.lat is None else "normalised_name_ar+lat"
        return None, ""


def in_turn(placed: DataFrame, most_years: int, refusals: bool) -> DataFrame:
    """(person, source, seq, chamber, method, refused), the last one as lists: every row. Components stay together, each is read in order."""
    kinds = dict(placed.dtypes)
    schema = f"person string, source {kinds['source']}, seq {kinds['seq']}, chamber {kinds['chamber']}, method string, r_person array<string>, r_chamber array<{kinds['chamber']}>, r_years array<{kinds['year']}>"
    fields = ("component", "source", "seq", "source_key", "ar_key", "lat_key", "chamber", "year", "born", "more")
    # Rows without a source_key are each alone, lest all of them meet in one place.
    alike = Window.partitionBy("source", "source_key", F.when(F.col("source_key").isNull(), F.col("seq"))).orderBy("seq")
    placed = placed.withColumn("more", F.lead(F.lit(True)).over(alike).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, resolver = None, Resolver(most_years)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                out, refused, offsets = [], Refused(), [0]
                for component, *row in zip(*(batch.column(c).to_pylist() for c in fields), strict=True):
                    if component != at:
                        at, resolver = component, Resolver(most_years)
                    out.append(resolver.take(*row, refused if refusals else None))
                    offsets.append(len(refused.persons))
                names = [pa.array(c, pa.string()) for c in zip(*out, strict=True)]
                lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, target.field(c).type.value_type)) for c, x in (("r_person", refused.persons), ("r_chamber", refused.chambers), ("r_years", refused.years))]
                yield pa.RecordBatch.from_arrays([names[0], *[batch.column(c) for c in ("source", "seq", "chamber")], names[1], *lists], schema=target)

    target = to_arrow_schema(T.StructType.fromDDL(schema))
    return placed.repartition("component").sortWithinPartitions("component", "rank", "seq").select(*fields).mapInArrow(run, schema)


def rounds(rows: DataFrame, most_years: int) -> DataFrame:
    """Coarser than in_turn(), for callers that ask for it: one round of joins for each chamber of each source, in order of trust and chamber.

    What a round sees of a person is what was known before it, and of rows with one source_key the first one of a round is resolved and the others follow. Rows are
    appended to one table and persons carried forward, so that a round reads each once.
    """
    spark = rows.sparkSession
    order = [(r["rank"], r["source"], r["chamber"]) for r in rows.select("rank", "source", "chamber").distinct().collect()]
    path = f"{shared_folder(spark).rstrip('/')}/rounds-{uuid.uuid4().hex}"
    delete_at_exit(spark.sparkContext, path)
    name = F.concat("source", F.lit(":"), F.col("seq").cast("string"))
    persons, out = None, []
    for i, (_, source, chamber) in enumerate(sorted(order, key=lambda x: (x[0], x[2] is not None, x[2]))):
        mine = rows.where((F.col("source") == source) & F.col("chamber").eqNullSafe(F.lit(chamber))).withColumn("own", F.struct(F.lit(i).alias("round"), F.col("seq")))
        leads = F.coalesce(F.min("own").over(Window.partitionBy("source", "source_key")) == F.col("own"), F.lit(True)) | F.col("source_key").isNull()
        mine = tabled(mine.withColumn("leads", leads))
        before = spark.read.parquet(path) if persons is not None else None
        if before is None:
            named, refused = mine.where("leads").select("own", name.alias("person"), F.lit("source_id").alias("method")), None
        else:
            upstream = before.where(F.col("source") == source).groupBy("source_key").agg(F.min_by("person", "own").alias("person"))
            by_key = mine.where("leads").join(upstream, "source_key").select("own", "person", F.lit("source_key").alias("method"))
            open_ = tabled(mine.where("leads").join(by_key.select("own"), "own", "left_anti"))
            k = before.where("method <> 'source_key'").select("ar_key", "lat_key", F.col("own").alias("k_own"), "person", F.col("chamber").alias("k_chamber"), F.col("year").alias("k_year")).join(persons, "person")
            far = too_far_apart(F.col("year"), F.col("k_year"), F.col("p_born"), most_years)
            both = open_["lat_key"].isNotNull() & F.col("p_lat").isNotNull()
            tried = ["own", "k_own", "person", "k_chamber", F.abs(F.col("year") - F.col("k_year")).alias("years_apart"), far.alias("far")]
            ar = open_.join(k.drop("lat_key"), "ar_key").select(*tried, F.lit(0).alias("by"), (~both | (open_["lat_key"] == F.col("p_lat"))).alias("agrees"), F.when(both, "normalised_name_ar+lat").otherwise("normalised_name_ar").alias("method"), "chamber")
            lt = open_.join(k.drop("ar_key"), "lat_key").select(*tried, F.lit(1).alias("by"), F.lit(True).alias("agrees"), F.lit("normalised_name_lat").alias("method"), "chamber")
            met = tabled(ar.unionByName(lt).where(~F.col("k_chamber").eqNullSafe(F.col("chamber"))))
            hits = tabled(met.where("NOT far AND agrees").groupBy("own").agg(F.min(F.struct("by", "k_own", "person", "method")).alias("hit")))
            refused = met.where("far").join(hits, "own", "left").where(F.col("hit").isNull() | (F.struct("by", "k_own") < F.struct("hit.by", "hit.k_own")))
            named = by_key.unionByName(open_.join(hits, "own", "left").select("own", F.coalesce("hit.person", name).alias("person"), F.coalesce("hit.method", F.lit("source_id")).alias("method")))
        led = tabled(mine.join(named, "own"))
        follow = mine.where("NOT leads").join(led.select("source_key", "person"), "source_key").withColumn("method", F.lit("source_key"))
        done = tabled(led.unionByName(follow))
        done.write.mode("append").parquet(path)
        brought = done.groupBy("person").agg(F.min_by("lat_key", F.when(F.col("lat_key").isNotNull(), F.col("own"))).alias("n_lat"), F.min_by("born", F.when(F.col("born").isNotNull(), F.col("own"))).alias("n_born"))
        if persons is None:
            persons = tabled(brought.toDF("person", "p_lat", "p_born"))
        else:
            persons = tabled(persons.join(brought, "person", "full").select("person", F.coalesce("p_lat", "n_lat").alias("p_lat"), F.coalesce("p_born", "n_born").alias("p_born")))
        years, other = F.lit(None).cast(rows.schema["year"].dataType), F.lit(None).cast(rows.schema["chamber"].dataType)
        out.append(done.select("person", "source", "seq", "chamber", "method", other.alias("other"), years.alias("years_apart")))
        if refused is not None:
            out.append(refused.select("person", F.lit(source).alias("source"), F.col("own.seq").alias("seq"), "chamber", F.lit(None).cast("string").alias("method"), F.col("k_chamber").alias("other"), "years_apart"))
    return reduce(DataFrame.unionByName, out)


def match_review(resolved: DataFrame) -> DataFrame:
    """The matches by name, each to be confirmed."""
    return resolved.where("method NOT IN ('source_id', 'source_key')").select("person", "source", "seq", "chamber", "method", "confidence", F.lit("confirm this is the same person").alias("action_required"))


def letter_tokens(df: DataFrame, key: str) -> DataFrame:
    """(key, token, size): the letters of each key, the second of a kind told from the first, and their number."""
    letters = df.select(key, F.posexplode(F.split(key, "")).alias("at", "letter")).where("letter <> ''")
    nth = F.row_number().over(Window.partitionBy(key, "letter").orderBy("at"))
    return letters.select(key, F.concat("letter", nth.cast("string")).alias("token"), F.length(key).alias("size"))


def alike(names: DataFrame, roster: DataFrame, least: float) -> DataFrame:
    """(a, b, ratio) of names a and roster names b whose matching ratio is `least` or more. Both: distinct texts in their one column.

    The ratio is twice the matched letters over all letters, so that such pairs share at least `least` / (2 - `least`) of either's letters.
    Hence the rarest of each's letters, as many as can be missing and one more, have one in common (prefix filtering). Of pairs that meet so, those whose
    lengths and common letters cannot reach the ratio go at once, then those whose longest common subsequence cannot; the rest is compared. No pair is lost.
    """
    a, b = names.toDF("a"), roster.toDF("b")
    part = least / (2 - least)
    tokens = letter_tokens(b, "b")
    rarity = tokens.groupBy("token").agg(F.count("*").alias("n"))

    def prefix(t: DataFrame, key: str) -> DataFrame:
        ranked = t.join(rarity, "token", "left").withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce("n", F.lit(0)), "token")))
        return ranked.where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * part - 1e-9) + 1).select(key, "token", F.col("size").alias(f"size_{key}"))

    met = prefix(letter_tokens(a, "a"), "a").join(prefix(tokens, "b"), "token")
    reach = least * (F.col("size_a") + F.col("size_b")) - 1e-9
    close = met.where(2 * F.least("size_a", "size_b") >= reach).select("a", "b", "size_a", "size_b").distinct()
    shared = F.size(F.array_intersect(numbered_letters("a"), numbered_letters("b")))
    return close.where(2 * shared >= reach).select("a", "b", similarity(F.col("a"), F.col("b"), least).alias("ratio")).where(F.col("ratio") >= least - 1e-9)


def numbered_letters(column: str) -> Column:
    """The letters of a text, the second of a kind told from the first."""
    letters = F.array_sort(F.filter(F.split(column, ""), lambda x: x != ""))
    return F.transform(letters, lambda x, i: F.concat(x, (i - F.array_position(letters, x)).cast("string")))


def fuzzy_resolve(names: DataFrame, roster: DataFrame, min_score: float = 0.7, min_margin: float = 0.1) -> DataFrame:
    """(name, resolved, how): each distinct name's seat. names: name; roster: seat, name (seat is the slug of the seat's name).

    The seat whose slug is the name's; else that with its folded key (of several the smallest); else that of the best matching ratio of the normalised
    names, if it is at least min_score and min_margin above the next seat's (of equal ratios the largest seat comes first); else ''.
    Only names without slug and key are compared: with ratios of min_score or more, and those whose best one lies less than the margin above it once more for what
    comes close below.
    """
    n = reliable(names.select("name").where("name IS NOT NULL").distinct().select("name", slug(F.col("name")).alias("slug"), match_key(normalize_latin(F.col("name"))).alias("key"), normalize_latin(F.col("name")).alias("plain")))
    r = reliable(roster.select("seat", match_key(normalize_latin(F.col("name"))).alias("key"), normalize_latin(F.col("name")).alias("plain")))
    exact = n.join(r, n["slug"] == r["seat"]).select("name", F.col("seat").alias("exact"))
    folded = n.where("key <> ''").join(r.drop("plain"), "key").groupBy("name").agg(F.min("seat").alias("folded"))
    sure = reliable(n.join(exact, "name", "left").join(folded, "name", "left"))
    open_, seats = sure.where("exact IS NULL AND folded IS NULL").select("name", "plain"), r.select("plain").distinct()
    high = reliable(alike(open_.select("plain").distinct(), seats, min_score))
    several = high.join(r.select(F.col("plain").alias("b"), "seat"), "b").groupBy("a").agg(F.max("ratio").alias("best"))
    unsure = several.where(F.col("best") - min_margin < min_score).select(F.col("a").alias("plain"))
    low = alike(unsure, seats, min_score - min_margin).where(F.col("ratio") < min_score - 1e-9)
    scored = high.unionByName(low).join(r.select("seat", F.col("plain").alias("b")), "b")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("ratio"), F.desc("seat")))
    top = scored.withColumn("place", place).where("place <= 2").groupBy("a").agg(F.max(F.when(F.col("place") == 1, F.struct("ratio", "seat"))).alias("top"), F.max(F.when(F.col("place") == 2, F.col("ratio"))).alias("next"))
    clear = (F.col("top.ratio") >= min_score) & (F.col("top.ratio") - F.coalesce("next", F.lit(0.0)) >= min_margin)
    best = top.where(clear).select(F.col("a").alias("plain"), F.col("top.seat").alias("near"))
    found = sure.join(best, "plain", "left")
    how = F.when(F.col("exact").isNotNull(), "slug").when(F.col("folded").isNotNull(), "key").when(F.col("near").isNotNull(), "ratio").otherwise("")
    return found.select("name", F.coalesce("exact", "folded", F.when(how == "ratio", F.col("near")), F.lit("")).alias("resolved"), how.alias("how"))


def pair_assign(lists: DataFrame, min_margin: float = 0.1) -> DataFrame:
    """(place, assignment, margin): how two Arabic names go with two Latin ones. lists: place, arabic and latin (arrays).

    'direct' or 'swapped', by the similarity of romanised and Latin names; 'open' if the two orders lie within min_margin, 'unequal' if
    the lists differ in length, and 'direct' for lists of one or none, whose margin is null. Of longer lists only the first two are weighed.
    """
    one = lists.withColumns({f"{c}{i}": normalize_latin(romanize(F.get(c, F.lit(i)))) if c == "arabic" else normalize_latin(F.get(c, F.lit(i))) for c in ("arabic", "latin") for i in (0, 1)})
    sims = {(i, j): similarity(F.col(f"arabic{i}"), F.col(f"latin{j}")) for i in (0, 1) for j in (0, 1)}
    margin = (sims[0, 0] + sims[1, 1]) - (sims[0, 1] + sims[1, 0])
    t = one.withColumn("margin", F.when((F.size("arabic") == F.size("latin")) & (F.size("arabic") >= 2), margin))
    verdict = F.when(F.size("arabic") != F.size("latin"), "unequal").when(F.size("arabic") < 2, "direct").when(F.abs("margin") < min_margin, "open").when(F.col("margin") > 0, "direct").otherwise("swapped")
    return t.select("place", verdict.alias("assignment"), F.round("margin", 6).alias("margin"))
