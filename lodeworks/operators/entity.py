"""Entity resolution of listings: match keys, the sequential fold, review decisions, property links.

The fold depends on order: an observation may match a canonical listing that an earlier one created; a match below the
automatic score goes to review and creates nothing. Every tier asks for equal beds and either an equal address, an equal
(zip, number, street token), or near coordinates. So observations that no chain of such keys connects never meet, and
the fold runs within the connected components of those keys: many small groups instead of one for each number of beds.
Addresses reach it as digests, with those beginnings of them that some observation asks for.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeworks.functions.text import address_normalise, address_parts, hashed_id

from .shared import components, table

#: Scores of the tiers, least score of an automatic merge, width of the coordinate box in degrees (fixed values).
STRICT, FLEX, PARTS, NEAR = 1.00, 0.92, 0.78, 0.70
AUTO, BOX = 0.85, 0.001
#: Rows of a bucket of groups, about.
BUCKET = 10_000


def match_keys(address: Column, beds: Column, baths: Column, lat: Column, lon: Column) -> Column:
    """Struct of the four tiers' keys; NULL where a part is missing."""
    p = address_parts(address)
    a = address_normalise(address)
    join = lambda *c: F.when(F.array_contains(F.transform(F.array(*c), lambda x: x.isNull()), True), F.lit(None)).otherwise(F.concat_ws("|", *c))
    s = lambda c: c.cast("string")
    return F.struct(
        join(a, s(beds), s(baths)).alias("strict"), join(a, s(beds)).alias("flex"), join(p["zip"], p["number"], p["token"], s(beds)).alias("parts"),
        join(s(F.round(lat, 3)), s(F.round(lon, 3)), s(beds)).alias("near"),
    )


def fits(obs: DataFrame) -> DataFrame:
    """(ord, zip, beds, query): for every observation the beginnings of its address that observations of equal zip and beds ask
    for as "number token", by their digests. Addresses are cut at the lengths asked for alone, and only those whose first word
    one of them has."""
    word = lambda c: F.regexp_extract(c, r"^(\S*)", 1)
    asked = obs.where("asks IS NOT NULL").select("zip", "beds", "asks").distinct()
    asked = asked.select("zip", "beds", word("asks").alias("first"), F.length("asks").alias("n"), F.sha2("asks", 256).alias("query"))
    lengths = asked.groupBy("zip", "beds", "first").agg(F.collect_set("n").alias("ns"))
    told = obs.where("addr IS NOT NULL").select("ord", "zip", "beds", "addr", word("addr").alias("first")).join(lengths, ["zip", "beds", "first"])
    begins = told.select("ord", "zip", "beds", F.explode(F.filter("ns", lambda n: n <= F.length("addr"))).alias("n"), "addr")
    begins = begins.select("ord", "zip", "beds", F.sha2(F.substring("addr", F.lit(1), F.col("n")), 256).alias("query"))
    return begins.join(asked.select("zip", "beds", "query"), ["zip", "beds", "query"], "left_semi").select("ord", "zip", "beds", "query")


def keyed(obs: DataFrame) -> DataFrame:
    """`obs` with texts as what the fold asks of them, so that its memory does not grow with their length: `addr` as a digest,
    `asks` as the digest of "number token" if some address begins with it, else NULL, and `begins`, what is asked for that the
    address begins with."""
    asks = F.when(F.coalesce(F.col("kept"), F.lit(False)), F.lit(None)).otherwise(F.concat("number", F.lit(" "), "token")) if "kept" in obs.columns else F.concat("number", F.lit(" "), "token")
    obs = obs.withColumn("asks", F.when(F.col("zip").isNotNull() & F.col("beds").isNotNull(), asks))
    found = table(fits(obs), "fits")
    begins = found.groupBy(F.col("ord").alias("_o")).agg(F.collect_set("query").alias("begins"))
    some = found.select(F.col("zip").alias("_z"), F.col("beds").alias("_b"), F.col("query").alias("_q")).distinct()
    slim = obs.withColumns({"addr": F.sha2("addr", 256), "asks": F.sha2("asks", 256)}).drop("number", "token")
    slim = slim.join(begins, F.col("ord") == F.col("_o"), "left").join(some, (F.col("zip") == F.col("_z")) & (F.col("beds") == F.col("_b")) & (F.col("asks") == F.col("_q")), "left")
    begins = F.coalesce("begins", F.array().cast("array<string>"))
    return table(slim.withColumns({"asks": F.col("_q"), "begins": begins}).drop("_o", "_z", "_b", "_q"), "keyed")


def groups(obs: DataFrame) -> DataFrame:
    """`obs`, rows of `keyed`, with `grp`: observations of different groups never meet. A key's members are linked to its smallest
    one; a coordinate cell's also to the smallest of the neighbouring cells."""
    # An observation looks around its rounded place, so two that meet are less than two boxes apart.
    cell = lambda c, d: (F.floor(c / (2 * BOX)) + d).cast("string")
    beds = F.col("beds").cast("string")
    here = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.array(F.struct("lat", "lon"))).otherwise(F.array().cast(_PLACES))
    places = F.concat(here, F.col("places")) if "places" in obs.columns else here
    near = F.flatten(F.transform(places, lambda p: F.array(*(F.concat_ws("|", F.lit("c"), cell(p["lat"], F.lit(i)), cell(p["lon"], F.lit(j)), beds) for i in (0, 1) for j in (0, 1)))))
    met = F.transform(F.concat("begins", F.array("asks")), lambda q: F.when(q.isNotNull(), F.concat_ws("|", F.lit("p"), "zip", q, beds)))
    keys = F.array_compact(F.concat(F.array(F.when(F.col("addr").isNotNull(), F.concat_ws("|", F.lit("a"), "addr", beds))), met, near))
    keys = table(obs.where("beds is not null").select("ord", F.explode(F.array_distinct(keys)).alias("k")), "keys")
    hubs = keys.groupBy("k").agg(F.min("ord").alias("a"))
    comp = components(keys.join(hubs, "k").select("a", F.col("ord").alias("b")), label="entities")
    # Most groups are of one row: a bucket of whole groups is folded at once, with the same decisions as each alone.
    grp, n = F.coalesce("comp", "ord"), max(8, obs.count() // BUCKET)
    return obs.join(comp, F.col("ord") == F.col("id"), "left").select(*obs.columns, grp.alias("grp"), F.pmod(F.xxhash64(grp), F.lit(n)).alias("bucket"))


_OUT = "ord long, action string, canonical long, score double, tier string"
_COLUMNS = ["ord", "addr", "beds", "baths", "zip", "number", "token", "lat", "lon"]
_KEYED = ["ord", "addr", "beds", "baths", "zip", "asks", "lat", "lon"]
_PLACES = "array<struct<lat:double,lon:double>>"


class _Canonicals:
    """The canonical listings so far, found by key: the first created one that a tier's test holds for. Every lookup costs the
    same however many there are, but for a look at the places in the cells at the edge of a coordinate box."""

    #: Cells a box is wide: those wholly inside need no look at their places.
    FINE = 4

    def __init__(self) -> None:
        self.rows: list[dict] = []
        self.strict, self.flex, self.prefix, self.cells = {}, {}, {}, {}

    def add(self, id_: int, addr, beds, baths, zip_, begins, places) -> int:
        n = len(self.rows)
        self.rows.append({"id": id_, "beds": beds, "baths": baths, "zip": zip_, "at": {}})
        if beds is not None and addr is not None:
            self.flex.setdefault((addr, beds), n)
            if baths is not None:
                self.strict.setdefault((addr, beds, baths), n)
            for query in begins:  # an address answers to each of its beginnings that is asked for
                self.prefix.setdefault((zip_, beds, query), n)
        for place in places:
            self.place(n, *place)
        return n

    def place(self, n: int, lat: float, lon: float) -> None:
        row = self.rows[n]
        row["at"][lat, lon] = None
        least, points = self.cells.setdefault((row["beds"], math.floor(lat * self.FINE / BOX), math.floor(lon * self.FINE / BOX)), [n, {}])
        points[lat, lon] = min(n, points.get((lat, lon), n))
        if n < least:
            self.cells[row["beds"], math.floor(lat * self.FINE / BOX), math.floor(lon * self.FINE / BOX)][0] = n

    def near(self, beds, lat: float, lon: float) -> int | None:
        i, j, best = math.floor(lat * self.FINE / BOX), math.floor(lon * self.FINE / BOX), None
        for di in range(-self.FINE, self.FINE + 1):
            for dj in range(-self.FINE, self.FINE + 1):
                least, points = self.cells.get((beds, i + di, j + dj), (None, None))
                if least is None or (best is not None and least >= best):
                    continue
                if max(abs(di), abs(dj)) < self.FINE - 1:  # wholly inside, rounding included
                    best = least
                    continue
                inside = [n for (a, b), n in points.items() if abs(a - lat) < BOX and abs(b - lon) < BOX]
                best = min([*inside, *([] if best is None else [best])], default=None)
        return best

    def find(self, r: dict) -> tuple[int | None, float, str | None]:
        beds, addr = r["beds"], r["addr"]
        if beds is None:
            return None, 0.0, None
        if addr is not None and r["baths"] is not None and (n := self.strict.get((addr, beds, r["baths"]))) is not None:
            return n, STRICT, "strict"
        if addr is not None and (n := self.flex.get((addr, beds))) is not None:
            return n, FLEX, "flex"
        if None not in (r["zip"], r["asks"]) and (n := self.prefix.get((r["zip"], beds, r["asks"]))) is not None:
            return n, PARTS, "parts"
        if None not in (r["lat"], r["lon"]) and (n := self.near(beds, round(r["lat"], 3), round(r["lon"], 3))) is not None:
            return n, NEAR, "near"
        return None, 0.0, None


def _resolve(rows: pd.DataFrame) -> tuple[pd.DataFrame, list[dict]]:
    """In order: match against the canonical listings so far, tier by tier; merge, review, or create. Rows with `places` are
    listings that earlier runs created. (decisions, all listings)"""
    canon, out, touched = _Canonicals(), [], set()
    for r in rows.sort_values(["kept", "ord"], ascending=[False, True]).to_dict("records"):
        miss = {k: None if pd.isna(r[k]) else r[k] for k in _KEYED}
        if r["kept"]:
            canon.add(r["ord"], *(miss[k] for k in ("addr", "beds", "baths", "zip")), r["begins"], [(x["lat"], x["lon"]) for x in r["places"]])
            continue
        n, score, tier = canon.find(miss)
        place = [(miss["lat"], miss["lon"])] if None not in (miss["lat"], miss["lon"]) else []
        if n is None:
            touched.add(canon.add(r["ord"], *(miss[k] for k in ("addr", "beds", "baths", "zip")), r["begins"], place))
            out.append((r["ord"], "new", r["ord"], 1.0, None))
            continue
        if score >= AUTO:
            touched.add(n)
            for at in place:
                canon.place(n, *at)
        out.append((r["ord"], "merged" if score >= AUTO else "review", canon.rows[n]["id"], score, tier))
    return pd.DataFrame(out, columns=["ord", "action", "canonical", "score", "tier"]), [canon.rows[n] for n in sorted(touched)]


def _asked(rows: pd.DataFrame) -> pd.DataFrame:
    """A frame with texts as `keyed` has them, undigested."""
    asks = [None if pd.isna(n) or pd.isna(t) else f"{n} {t}" for n, t in zip(rows["number"], rows["token"], strict=True)]
    known, lengths = set(asks), sorted({len(q) for q in asks if q is not None})
    begins = [[] if pd.isna(a) else [a[:n] for n in lengths if n <= len(a) and a[:n] in known] for a in rows["addr"]]
    return rows.assign(asks=asks, begins=begins)


def _fold(rows: pd.DataFrame) -> pd.DataFrame:
    """The decisions on new observations alone."""
    rows = rows if "asks" in rows.columns else _asked(rows)
    return _resolve(rows.assign(kept=False, places=None))[0]


def fold(obs: DataFrame) -> DataFrame:
    """(ord, action new | merged | review, canonical, score, tier) for observations (ord, addr, beds, baths, zip, number,
    token, lat, lon, ...); canonical is the ord of the observation that created the listing."""
    return groups(keyed(obs.select(*_COLUMNS))).groupBy("bucket").applyInPandas(_fold, _OUT)


_LISTING = f"id long, addr string, beds double, baths double, zip string, places {_PLACES}"


def fold_onto(listings: DataFrame, obs: DataFrame) -> DataFrame:
    """One run over new observations, against the listings (id, addr, beds, baths, zip, places) of earlier runs: rows of `fold`
    with `listing` null, and one row with `listing` for every listing created or changed. Only listings that share a key with
    a new observation are read into its group, so a run's work grows with its observations."""
    old = listings.select(
        F.col("id").alias("ord"), "addr", F.col("beds").cast("double").alias("beds"), F.col("baths").cast("double").alias("baths"), "zip", F.regexp_extract(F.coalesce("addr", F.lit("")), r"^(\S+)", 1).alias("number"), F.lit("").alias("token"),
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit(True).alias("kept"), "places",
    )
    new = obs.select(*_COLUMNS, F.lit(False).alias("kept"), F.array().cast(_PLACES).alias("places"))
    both = new.unionByName(old)
    rows = groups(keyed(both))
    # Groups of listings alone decide nothing.
    live = rows.where("NOT kept").select("grp").distinct()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done, changed = _resolve(pdf)
        done["listing"] = None
        at = [{k: r[k] for k in ("id", "beds", "baths", "zip")} | {"addr": None, "places": [{"lat": a, "lon": b} for a, b in r["at"]]} for r in changed]
        more = pd.DataFrame({"ord": [r["id"] for r in changed], "action": "listing", "canonical": [r["id"] for r in changed], "score": 1.0, "tier": None, "listing": at})
        return pd.concat([d for d in (done, more) if len(d)], ignore_index=True)

    listing = _LISTING.replace(" long", ":long").replace(" string", ":string").replace(" double", ":double").replace("places array", "places:array").replace(", ", ",")
    done = rows.join(live, "grp", "left_semi").groupBy("bucket").applyInPandas(run, f"{_OUT}, listing struct<{listing}>")
    # The fold knows addresses by digest only; a listing's is that of the row that created it.
    texts = both.select(F.col("ord").alias("_o"), F.col("addr").alias("_addr"))
    done = done.join(texts, F.col("listing.id") == F.col("_o"), "left")
    return done.select("ord", "action", "canonical", "score", "tier", F.when(F.col("listing").isNotNull(), F.col("listing").withField("addr", F.col("_addr"))).alias("listing"))


class Ledger:
    """Incremental resolution kept in a folder: every run takes the observations that no run has decided, folds them onto the
    listings of the last one, and writes a folder of its own. A run counts once its listings are whole; one that was cut off
    is done again. Runs over parts in order equal one over all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _whole(self) -> list[int]:
        from lodeworks.sources.sinks import exists

        n = 0
        while exists(self.spark, f"{self.path}/run={n}/listings/_SUCCESS"):
            n += 1
        return list(range(n))

    def decisions(self) -> DataFrame:
        at = [f"{self.path}/run={n}/decisions" for n in self._whole()]
        return self.spark.read.schema(_OUT).parquet(*at) if at else self.spark.createDataFrame([], _OUT)

    def listings(self) -> DataFrame:
        runs = self._whole()
        return self.spark.read.schema(_LISTING).parquet(f"{self.path}/run={runs[-1]}/listings") if runs else self.spark.createDataFrame([], _LISTING)

    def run(self, obs: DataFrame) -> None:
        """Decide the rows of `obs` (as `fold` takes them) that are not decided yet."""
        here = f"{self.path}/run={len(self._whole())}"
        old = self.listings()
        todo = obs.join(self.decisions().select("ord"), "ord", "left_anti")
        both = table(fold_onto(old, todo), "fold")
        both.where("listing IS NULL").select("ord", "action", "canonical", "score", "tier").write.mode("overwrite").parquet(f"{here}/decisions")
        changed = both.where("listing IS NOT NULL").select("listing.*")
        old.join(changed.select("id"), "id", "left_anti").unionByName(changed).write.mode("overwrite").parquet(f"{here}/listings")


#: Version of the address rule.
ADDRESS_VERSION = 1


def renormalise(obs: DataFrame, address: str = "address", version: int = ADDRESS_VERSION) -> DataFrame:
    """`obs` with addr and addr_version brought up to `version`: rows of an earlier version (or none) get the address by the
    rule as it is now, the others stay as they are."""
    old = F.coalesce(F.col("addr_version"), F.lit(0)) < version
    return obs.withColumns({"addr": F.when(old, address_normalise(F.col(address))).otherwise(F.col("addr")), "addr_version": F.when(old, F.lit(version)).otherwise(F.col("addr_version"))})


def observations(df: DataFrame, order: str, address: str) -> DataFrame:
    """Rows with the columns that the fold reads."""
    p = address_parts(F.col(address))
    return df.select("*", F.col(order).cast("long").alias("ord"), address_normalise(F.col(address)).alias("addr"), p["number"].alias("number"), p["token"].alias("token"), p["zip"].alias("zip"))


def canonical(obs: DataFrame, folded: DataFrame) -> DataFrame:
    """One row a canonical listing: first and last day, least/largest and latest rent, first size, sources and
    observations in order, least confidence; ids are hashes of the first observation's id."""
    j = obs.join(folded.where("action <> 'review'").select(F.col("ord").alias("_o"), "canonical", "score"), F.col("ord") == F.col("_o"))
    seen = lambda c, first: (F.min_by if first else F.max_by)(F.col(c), F.when(F.col(c).isNotNull(), F.col("ord")))
    return j.groupBy("canonical").agg(
        F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.min("rent").alias("min_rent"), F.max("rent").alias("max_rent"), seen("rent", False).alias("rent"),
        seen("sqft", True).alias("sqft"), F.min_by("addr", "ord").alias("address"), F.min_by("beds", "ord").alias("beds"), F.min("score").alias("confidence"), F.count("*").alias("n_observations"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", "source"))), lambda x: x["source"])).alias("sources"),
    ).withColumn("canonical_id", hashed_id(F.col("canonical").cast("string"), prefix="c_"))


def review_queue(folded: DataFrame) -> DataFrame:
    return folded.where("action = 'review'").select("ord", F.col("canonical").alias("candidate"), "score", "tier", F.lit("").alias("decision"))


def apply_decisions(folded: DataFrame, decisions: DataFrame) -> DataFrame:
    """Manual decisions on reviewed rows: merge, keep_separate, merge_into:<id>; others leave the row in review."""
    d = decisions.select(F.col("ord").alias("_o"), "decision")
    j = folded.join(d, F.col("ord") == F.col("_o"), "left")
    into = F.regexp_extract(F.coalesce("decision", F.lit("")), r"^merge_into:(\d+)$", 1).try_cast("bigint")
    open_ = F.col("action") == "review"
    act = F.when(open_ & ((F.col("decision") == "merge") | into.isNotNull()), "merged").when(open_ & (F.col("decision") == "keep_separate"), "new").otherwise(F.col("action"))
    to = F.when(open_ & into.isNotNull(), into).when(open_ & (F.col("decision") == "keep_separate"), F.col("ord")).otherwise(F.col("canonical"))
    return j.select("ord", act.alias("action"), to.alias("canonical"), "score", "tier", (open_ & (act != "review")).alias("manual_override"))


def link_properties(listings: DataFrame, register: DataFrame, width: float = 0.0005) -> DataFrame:
    """Listings to properties: equal address (the register's last one wins), else the first within a coordinate box."""
    from .joins import band_first, last_wins

    exact = last_wins(register.where("addr is not null"), ["addr"], "property_ord").select(F.col("addr").alias("_a"), F.col("property_id").alias("_p"))
    first = table(listings.join(exact, F.col("addr") == F.col("_a"), "left"), "links")
    rest = first.where("_p is null and lat is not null and lon is not null").select("listing_id", F.col("lat").alias("la"), F.col("lon").alias("lo"))
    near = band_first(rest, register.select("property_id", "property_ord", F.col("lat").alias("pa"), F.col("lon").alias("po")), [("la", "pa"), ("lo", "po")], width, "listing_id", "property_ord")
    near = near.select(F.col("listing_id").alias("_l"), F.col("property_id").alias("_q"))
    return first.join(near, F.col("listing_id") == F.col("_l"), "left").select(*listings.columns, F.coalesce("_p", "_q").alias("property_id"))
