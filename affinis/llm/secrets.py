"""Secret scans: regular-expression spans plus corpus-wide ownership frequency of what they hold.

DataFrame functions only. Positions come from lengths: a text splits at its matches, so the k-th match starts after
the first k gaps and k-1 matches. A candidate is a span's secret value, known by its hash. Counting the distinct
owners and repositories of each hash over the whole corpus tells examples, which many owners copy, from credentials
that stay with one owner. Base spans are always reported; of the generic long tokens only those are, which look live.

Nulls and edge cases: a null text counts as empty and has no spans; a null owner or repository is one of its own
(the empty name); repeated rows are rows of their own; an empty table gives an empty result; other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

# Fixed values of the contract: the kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "generic")
_WORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in _WORDS) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the run AKIA[A-Z0-9]+ of 20 or more
HEX = r"[0-9a-f]{24,}"  # the run [0-9a-f]+ of 24 or more
#: Candidates of the method: long runs of key characters that mix letters and digits.
GENERIC = r"[A-Za-z0-9+/_=-]{24,}"

#: A value known to more owners or repositories than these is an example that is copied about.
MAX_OWNERS, MAX_REPOS = 2, 4
#: Matches that are placed together.
BLOCK = 256

NONE = "array<struct<s:bigint,r:int,e:bigint,v:string>>"


def _blocks(rows: Column) -> Column:
    """Numbers of the blocks of BLOCK elements that an array falls into."""
    none = F.array().cast("array<int>")
    return F.when(F.size(rows) > 0, F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))).otherwise(none)


def _block(rows: Column, b: Column) -> Column:
    return F.slice(rows, b * BLOCK + 1, F.lit(BLOCK))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _spans(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """All leftmost non-overlapping matches as (start, kind's rank, end, value of the group), in code points.

    A block's matches are placed one after the other from where the blocks before it end, so work is linear in matches.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits

    def walk(rows: Column, begin: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + x["n"]
            span = F.struct(start.alias("s"), F.lit(kind).alias("r"), end.alias("e"), x["v"].alias("v"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

        zero = F.struct(begin.alias("at"), F.array().cast(NONE).alias("out"))
        return F.aggregate(rows, zero, lambda a, x: step(a, x).cast(f"struct<at:bigint,out:{NONE}>"), lambda a: a["out"])

    def placed(z: Column) -> Column:
        sizes = F.transform(_blocks(z), lambda b: _sum(F.transform(_block(z, b), lambda x: x["gap"] + x["n"])))
        return let(sizes, lambda n: F.flatten(F.transform(_blocks(z), lambda b: walk(_block(z, b), _sum(F.slice(n, F.lit(1), b))))))

    long = lambda c: F.length(c).cast("long")
    rows = let(F.struct(hits.alias("hits"), gaps.alias("gaps"), values.alias("values")), lambda z: F.transform(
        z["hits"], lambda hit, k: F.struct(long(F.get(z["gaps"], k)).alias("gap"), long(hit).alias("n"), F.get(z["values"], k).alias("v"))))
    return let(rows, placed)


def _where(may: Column, spans: Column) -> Column:
    return F.when(may, spans).otherwise(F.array().cast(NONE))


def base_spans(text: Column) -> Column:
    """The spans of the contract, sorted by start, then kind. text must not be null."""
    assign = _where((F.instr(text, ":") > 0) | (F.instr(text, "=") > 0), _where(text.rlike(ASSIGN), _spans(text, ASSIGN, 0, 2)))
    access = _where(F.instr(text, "AKIA") > 0, _spans(text, ACCESS, 1))
    hexes = _where(text.rlike(HEX), _spans(text, HEX, 2))
    return F.sort_array(F.concat(F.filter(assign, lambda x: F.length(x["v"]) >= 6), access, hexes))


def generic_spans(text: Column) -> Column:
    """Long mixed tokens anywhere in the text."""
    live = lambda x: x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")
    return F.filter(_where(text.rlike(GENERIC), _spans(text, GENERIC, 3)), live)


def _apart(generic: Column, base: Column) -> Column:
    """The generic spans that touch no base span; a block of them looks only at the base spans in its reach."""
    touch = lambda a, b: (a["s"] < b["e"]) & (b["s"] < a["e"])

    def of(rows: Column) -> Column:
        reach = F.struct(rows[0]["s"].alias("s"), F.element_at(rows, -1)["e"].alias("e"))
        return let(F.filter(base, lambda b: touch(reach, b)), lambda near: F.filter(rows, lambda g: ~F.exists(near, lambda b: touch(g, b))))

    return F.flatten(F.transform(_blocks(generic), lambda b: let(_block(generic, b), of)))


def _candidates(df: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column) -> DataFrame:
    """Per row: base spans and those generic spans that touch none of them; values only as hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = lambda a: F.transform(a, lambda x: F.struct(x["s"].alias("s"), x["r"].alias("r"), x["e"].alias("e"), F.sha2(x["v"], 256).alias("h")))
    both = F.struct(base_spans(text).alias("b"), generic_spans(text).alias("g"))
    found = let(both, lambda z: F.struct(hashed(z["b"]).alias("base"), hashed(_apart(z["g"], z["b"])).alias("more")))
    row = df.select(F.col(id_col).alias("id"), owner.alias("owner"), repo.alias("repo"), found.alias("f"))
    return row.select("id", "owner", "repo", F.monotonically_increasing_id().alias("row"), "f.base", "f.more")


def ownership(cands: DataFrame) -> DataFrame:
    """(h, owners, repos, live) of every candidate hash; cands holds (h, owner, repo) rows.

    Distinct triples are made first, with partial aggregation before the shuffle, so a value that fills a third of the
    corpus costs one row per task.
    """
    pairs = cands.groupBy("h", "owner", "repo").agg(F.count("*").alias("n"))
    owners = pairs.groupBy("h", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
    per = owners.groupBy("h").agg(F.count("*").alias("owners"), F.sum("r").alias("repos"), F.sum("n").alias("uses"))
    return per.withColumn("live", (F.col("owners") <= MAX_OWNERS) & (F.col("repos") <= MAX_REPOS))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None, repo: Column | None = None) -> DataFrame:
    """One row per input row: (id, base, more, live, example).

    base and more are arrays of spans (s, r, e, h): of the contract, and of the generic tokens that look live. live and
    example count the base spans whose value is owner-specific or copied about.
    """
    empty = F.lit("")
    rows = stored(_candidates(df, id_col, text_col, empty if owner is None else F.coalesce(owner.cast("string"), empty), empty if repo is None else F.coalesce(repo.cast("string"), empty)))
    some = rows.where((F.size("base") > 0) | (F.size("more") > 0))
    each = some.select("row", "owner", "repo", F.explode(F.concat("base", "more")).alias("x")).select("row", "owner", "repo", "x", "x.h")
    verdict = stored(ownership(each.select("h", "owner", "repo")).where("live").select("h"))  # stored, so that a hot value's rows can be split
    generic = F.col("x.r") == KINDS.index("generic")
    live = each.select("row", "x", "h").join(verdict, "h").groupBy("row").agg(F.count_if(~generic).alias("live"), F.collect_list(F.when(generic, F.col("x"))).alias("live_more"))
    joined = rows.join(live, "row", "left")
    n_live = F.coalesce("live", F.lit(0)).cast("long")
    more = F.coalesce(F.sort_array("live_more"), F.filter("more", lambda x: F.lit(False)))
    return joined.select("id", "base", more.alias("more"), n_live.alias("live"), (F.size("base") - n_live).alias("example"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["r"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from scan()'s rows."""
    n = lambda rank: F.size(F.filter("base", lambda x: x["r"] == rank)).cast("long")
    return scanned.select(
        F.col("id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.sort_array(F.concat("base", "more"))).alias("spans"),
        F.size("more").cast("long").alias("n_generic"), F.col("live").alias("n_live"), F.col("example").alias("n_example"),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """text with each maximal run of overlapping spans (sorted by start) replaced by mark. Blocks of spans read their stretch of text only."""
    kind = "struct<at:bigint,out:array<string>>"
    upto = lambda rows: F.coalesce(F.array_max(F.transform(rows, lambda x: x["e"])), F.lit(0).cast("long"))

    def pieces(rows: Column, begin: Column) -> Column:
        def cut(stretch: Column) -> Column:
            def step(acc: Column, x: Column) -> Column:
                gap = F.substr(stretch, (acc["at"] - begin + 1).cast("int"), F.greatest(x["s"] - acc["at"], F.lit(0)).cast("int"))
                fresh = F.struct(x["e"].alias("at"), F.concat(acc["out"], F.array(gap, F.lit(mark))).alias("out")).cast(kind)
                return F.when(x["s"] >= acc["at"], fresh).otherwise(F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out")).cast(kind))

            return F.aggregate(rows, F.struct(begin.alias("at"), F.array().cast("array<string>").alias("out")).cast(kind), step, lambda a: a["out"])

        return let(F.substr(text, (begin + 1).cast("int"), F.greatest(upto(rows) - begin, F.lit(0)).cast("int")), cut)

    def whole(z: Column) -> Column:
        parts = F.transform(_blocks(z["spans"]), lambda b: let(_block(z["spans"], b), lambda rows: pieces(rows, F.coalesce(F.array_max(F.slice(z["ends"], F.lit(1), b)), F.lit(0).cast("long")))))
        return F.concat(F.array_join(F.flatten(parts), ""), F.substr(text, (upto(z["spans"]) + 1).cast("int"), F.length(text)))

    ends = F.transform(_blocks(spans), lambda b: upto(_block(spans, b)))
    return let(F.struct(spans.alias("spans"), ends.alias("ends")), whole)


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang") -> DataFrame:
    """df with every reported secret blotted out of its text; rows without secrets pass unchanged, none is dropped.

    Ownership is counted over all of df. The few rows that hold candidates are set apart, so the rest is never shuffled.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    may = ((F.instr(text, ":") > 0) | (F.instr(text, "=") > 0)) & text.rlike(ASSIGN) | (F.instr(text, "AKIA") > 0) | text.rlike(HEX) | text.rlike(r"[A-Za-z0-9+/_=-]{24,}") & text.rlike("[0-9]")
    rows = stored(df.where(may).select(F.monotonically_increasing_id().alias("_secret_row"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_secret_doc")))
    inner = rows.select("_secret_row", F.col("_secret_doc")[text_col].alias("text"), F.col("_secret_doc")[owner_col].alias("owner"), F.concat_ws("/", F.col("_secret_doc")[owner_col], F.col("_secret_doc")[repo_col]).alias("repo"))
    found = scan(inner, "_secret_row", "text", F.col("owner"), F.col("repo")).select(F.col("id").alias("_secret_row"), F.sort_array(F.concat("base", "more")).alias("_secret_spans"))
    blot = redacted(F.coalesce(F.col("_secret_doc")[text_col], F.lit("")), F.col("_secret_spans"))
    doc = F.col("_secret_doc")
    clean = F.when(F.size("_secret_spans") > 0, blot).otherwise(doc[text_col])
    out = rows.join(found, "_secret_row").select(*[(clean if c == text_col else doc[c]).alias(c) for c in df.columns])
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_col).isNotNull(), F.length(text_col).cast(df.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return df.where(~may).unionByName(out)
