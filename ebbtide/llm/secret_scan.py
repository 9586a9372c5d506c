"""Secrets in texts, told apart by who owns them across the corpus.

Spans are found with regular expressions in SQL functions. The digest of each candidate value (without full stops at its end) is
then aggregated over the corpus: in how many distinct repositories, and under how many distinct
owners does it occur? A value that many owners share is a copied example. One that a single owner or
two hold is a live-looking credential, unless it is a recognisable placeholder: made of words like "changeme" or "your_api_key" alone, or
of a few characters over and over. It need be neither long nor random, nor hold a digit. Where a live value stands bare, as a word of its own, it gets a span of kind
"bare" as well; bare occurrences count for ownership too, so that a word of the language is not taken for a secret.

Defined results: a null text is empty and has no spans. Null owners, and null repositories, count as
one owner or repository. Repeated rows count once per (owner, repository). Nothing is capped: all of
every text is searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.frames import BROADCAST_KEYS, fresh, named, sieved, sized, stored

# The kinds in order, their patterns, which group holds the value, and its least length.
KINDS = ("assign", "access", "hex")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run is a match of ``AKIA[A-Z0-9]+`` with 20 characters exactly if this matches it.
ACCESS = r"AKIA[A-Z0-9]{16,}"
#: Likewise for ``[0-9a-f]+`` with 24.
HEX = r"[0-9a-f]{24,}"
LEAST_ASSIGNED = 6

#: Under so many distinct owners a value is a copied example.
WIDELY = 3
#: A value has as many different characters as a quarter of its length, up to that of so many characters; three at least.
VARIED_LENGTH, LEAST_VARIED = 32, 3
#: Words that values stand for something else with. A placeholder is made of nothing but these.
PLACEHOLDER_WORDS = (
    "access", "admin", "api", "auth", "bar", "baz", "change", "default", "dummy", "empty", "enter", "example", "fake", "false", "fill",
    "foo", "goes", "here", "hidden", "id", "in", "insert", "key", "me", "my", "name", "none", "null", "pass", "passwd", "password",
    "placeholder", "put", "redacted", "replace", "root", "sample", "secret", "set", "some", "string", "test", "the", "this", "to", "todo",
    "token", "true", "undefined", "user", "value", "with", "x+", "your", r"\*+",
)
PLACEHOLDER = "(?i)^(?:(?:" + "|".join(PLACEHOLDER_WORDS) + r")[_.+/=-]*)+[0-9]{0,3}$"
MASK = "[SECRET]"

#: Where a value may stand bare: a run of a value's characters, without what separates a key from it.
TOKEN = r"[A-Za-z0-9+/_.-]{6,}={0,2}"
BARE = "bare"

SPAN = "struct<start:int,end:int,kind:string,digest:string,hash:bigint,random:boolean>"
LABELLED = "struct<start:int,end:int,kind:string,digest:string,label:string,n_repositories:long,n_owners:long>"


def core(value: Column) -> Column:
    """A value without the full stops of a sentence that it ends."""
    return F.regexp_replace(value, r"\.+$", "")


def plausible(value: Column) -> Column:
    """Whether a value could be a credential: neither made of a placeholder's words nor of a few characters over and over."""
    different = F.size(F.array_distinct(F.split(value, "")))
    varied = (different >= LEAST_VARIED) & (4 * different >= F.least(F.length(value), F.lit(VARIED_LENGTH)))
    return varied & ~value.rlike(PLACEHOLDER)


def _found(text: Column, pattern: str, span) -> Column:
    """The spans of one pattern: what lies between the matches tells where they are. ``span`` gives (span, whether to keep it)
    from a match and its start."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.length(pair["gap"])
        new, kept = span(pair["match"], start)
        return F.struct(
            (start + F.length(pair["match"])).alias("at"),
            F.when(kept, F.concat(done["spans"], F.array(new))).otherwise(done["spans"]).cast(f"array<{SPAN}>").alias("spans"),
        )

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(g.alias("gap"), m.alias("match")))
    return F.when(text.rlike(pattern), F.aggregate(pairs, begin, step)["spans"]).otherwise(begin["spans"])


def _span(kind: str, start: Column, end: Column, value: Column) -> Column:
    own = core(value)
    return F.struct(
        start.alias("start"),
        end.alias("end"),
        F.lit(kind).alias("kind"),
        F.sha2(own, 256).alias("digest"),
        F.xxhash64(own).alias("hash"),
        plausible(own).alias("random"),
    )


def _of_kind(text: Column, kind: str, pattern: str) -> Column:
    def span(match: Column, start: Column) -> tuple[Column, Column]:
        value = F.regexp_extract(match, pattern, 2) if kind == "assign" else match
        kept = F.length(value) >= LEAST_ASSIGNED if kind == "assign" else F.lit(True)
        return _span(kind, start, start + F.length(match), value), kept

    return _found(text, pattern, span)


def _in_order(spans: Column) -> Column:
    order = {kind: i for i, kind in enumerate((*KINDS, BARE))}
    number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])

    def before(a: Column, b: Column) -> Column:
        left, right = a["start"] * 10 + number[a["kind"]], b["start"] * 10 + number[b["kind"]]
        return F.when(left < right, -1).when(left > right, 1).otherwise(0)

    return F.array_sort(spans, before)


def spans(text: Column) -> Column:
    """All base spans of a text, by start and then by kind; places count code points, ends are exclusive."""
    text = F.coalesce(text, F.lit(""))
    each = [_of_kind(text, kind, pattern) for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX), strict=True)]
    return _in_order(F.concat(*each))


def bare_spans(text: Column, digests: Column, base: Column) -> Column:
    """Where values of these ``digests`` stand in the text, outside the ``base`` spans."""

    def span(match: Column, start: Column) -> tuple[Column, Column]:
        own = core(match)
        return _span(BARE, start, start + F.length(own), own), F.array_contains(digests, F.sha2(own, 256))

    there = _found(F.coalesce(text, F.lit("")), TOKEN, span)
    return F.filter(there, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def ownership(candidates: DataFrame, widely: int = WIDELY) -> DataFrame:
    """One row per value digest from rows (``digest``, ``hash``, ``random``, ``owner``, ``repository``): the numbers of
    distinct repositories and owners, and the label. Each step combines rows before they move, so that
    a value found in a third of all documents is a few rows per task."""
    value = ("digest", "hash", "random")
    pairs = candidates.groupBy(*value, "owner", "repository").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy(*value, "owner").agg(F.count("*").alias("repositories"))
    totals = owners.groupBy(*value).agg(F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"))
    label = F.when(F.col("n_owners") >= widely, "copied").when(F.col("random"), "live").otherwise("placeholder")
    return totals.select(*value, "n_repositories", "n_owners", label.alias("label"))


def _bare_hits(keyed: DataFrame, sought: DataFrame) -> DataFrame:
    """Where the ``sought`` values stand as words of their own: a row (key, owner, repository, digest, hash, random) each.

    Words are looked up by their hashes inside the scan's tasks; a sieve of bounded size goes first if the values are too many to send."""
    tokens = keyed.select("key", "owner", "repository", F.explode(F.regexp_extract_all("body", F.lit(TOKEN), F.lit(0))).alias("token"))
    cores = tokens.select("key", "owner", "repository", core(F.col("token")).alias("own")).where(F.length("own") >= LEAST_ASSIGNED)
    hashed = cores.withColumn("hash", F.xxhash64("own"))
    if sought.count() > BROADCAST_KEYS:
        hashed = sieved(hashed, "hash", sought)
    met = hashed.join(sized(sought), "hash").where(F.sha2("own", 256) == F.col("digest"))
    return met.select("key", "owner", "repository", "digest", "hash", F.lit(True).alias("random"))


def labelled(docs: DataFrame, text: str, owner: str, repository: str, widely: int = WIDELY) -> DataFrame:
    """One row per distinct text with a span: ``key`` (its digest, ``key_of``) and ``spans``, each with its label and counts.

    First the base spans give candidate values and their owners. Values that look live are then looked for in all texts, also where they
    stand bare; an occurrence counts for ownership wherever it is, so a value that turns out to be a common word is a copied one.
    What is still live adds a span wherever it stands outside the base spans."""
    body = F.coalesce(named(docs, text), F.lit(""))
    keyed = docs.select(
        named(docs, owner).alias("owner"), named(docs, repository).alias("repository"), key_of(named(docs, text)).alias("key"), body.alias("body")
    )
    base = stored(keyed.select("owner", "repository", "key", spans(F.col("body")).alias("spans")).where(F.size("spans") > 0), "secret-spans")
    candidates = base.select("owner", "repository", F.inline("spans")).select("digest", "hash", "random", "owner", "repository")
    sought = stored(ownership(candidates, widely).where("label = 'live'").select("digest", "hash"), "secrets-sought")
    hits = stored(_bare_hits(keyed, sought), "bare-secrets")
    owned = stored(ownership(candidates.unionByName(hits.drop("key")), widely), "secret-owners")
    live = owned.where("label = 'live'").select("digest")
    by_text = hits.join(sized(live), "digest", "left_semi").groupBy("key").agg(F.collect_set("digest").alias("digests"))
    by_text = stored(by_text, "bare-by-text")
    of_base = base.groupBy("key").agg(F.first("spans").alias("base"))
    texts = keyed.select("key", "body").join(sized(by_text), "key").join(sized(of_base), "key", "left")
    known = F.coalesce("base", F.array().cast(f"array<{SPAN}>"))
    added = texts.select("key", bare_spans(F.col("body"), F.col("digests"), known).alias("bare")).where(F.size("bare") > 0)
    added = stored(added, "bare-spans").groupBy("key").agg(F.first("bare").alias("bare"))
    both = of_base.join(added, "key", "full")
    nothing = F.array().cast(f"array<{SPAN}>")
    every = both.select("key", _in_order(F.concat(F.coalesce("base", nothing), F.coalesce("bare", nothing))).alias("spans"))
    # Texts with the same list of values get the same labels: they are joined once per list.
    digests = F.transform("spans", lambda s: s["digest"])
    listed_ = stored(every.withColumn("list", F.sha2(F.array_join(digests, ","), 256)), "secret-lists")
    lists = listed_.groupBy("list").agg(F.first(digests).alias("digests"))
    labels = (
        lists.select("list", F.posexplode("digests").alias("place", "digest"))
        .join(owned.select("digest", "label", "n_repositories", "n_owners"), "digest")
        .groupBy("list")
        .agg(F.sort_array(F.collect_list(F.struct("place", "label", "n_repositories", "n_owners"))).alias("labels"))
    )
    told = F.zip_with(
        "spans",
        "labels",
        lambda s, l: F.struct(
            *[s[c].alias(c) for c in ("start", "end", "kind", "digest")], *[l[c].alias(c) for c in ("label", "n_repositories", "n_owners")]
        ),
    )
    return stored(listed_.join(labels, "list").select("key", told.alias("spans")), "labelled-secrets")


def key_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _small(found: DataFrame) -> DataFrame:
    """``found``, marked for a broadcast if it has few spans in all; otherwise the join shuffles."""
    spans_ = found.agg(F.sum(F.size("spans").cast("long")) + F.count("*")).first()[0] or 0
    return F.broadcast(found) if spans_ <= BROADCAST_KEYS // 8 else found


def scan(
    docs: DataFrame, text: str, owner: str, repository: str, keep: list[str], widely: int = WIDELY
) -> DataFrame:
    """One row per document: the columns ``keep``, and ``spans`` with the label and counts of each span."""
    found = labelled(docs, text, owner, repository, widely)
    slim = docs.select(*[named(docs, c).alias(f"keep_{i}") for i, c in enumerate(keep)], key_of(named(docs, text)).alias("key"))
    kept = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)]
    nothing = F.array().cast(f"array<{LABELLED}>")
    return slim.join(_small(found), "key", "left").select(*kept, F.coalesce("spans", nothing).alias("spans"))


def masked(text: Column, spans: Column, label: str = "live") -> Column:
    """The text with each span of this label replaced by a mask; spans that overlap share one."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        new = span["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(new, F.concat(done["out"], gap, F.lit(MASK))).otherwise(done["out"]).alias("out"),
        )

    done = F.aggregate(F.filter(spans, lambda s: s["label"] == label), begin, step)
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))


def redact(docs: DataFrame, text: str, owner: str, repository: str, widely: int = WIDELY) -> DataFrame:
    """``docs`` with every live-looking credential masked, also where it stands bare; all rows and columns stay, also other
    columns' values. Texts without one stay as they are."""
    key, found = fresh(docs.columns, "_key"), fresh(docs.columns, "_found")
    live = labelled(docs, text, owner, repository, widely).where(F.exists("spans", lambda s: s["label"] == "live"))
    told = _small(live).select(F.col("key").alias(key), F.col("spans").alias(found))
    keyed = docs.withColumn(key, key_of(named(docs, text))).join(told, key, "left")
    own = F.col(f"`{text}`")
    fixed = F.when(F.col(found).isNull(), own).otherwise(masked(own, F.col(found)))
    return keyed.select(*[fixed.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
