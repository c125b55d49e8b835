"""Secret scans with multipart credential linking.

Patterns give spans by themselves (``assign``, ``access``, ``hex``). Beside them stand *weak parts*, which mean
little alone: access identifiers, secret-like strings and endpoints. Every part is an interval of
characters, stretched by its scope; an interval join by cells finds which secret-like strings
have an identifier or endpoint in scope, and which identifiers a secret. Only those are reported, as kinds
``id`` and ``secret``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The base patterns, their least lengths and order. Runs of one set of characters that are too
# short never match, which finds the same as dropping them; group 2 of an assignment is measured after the match.
LEAST = {"assign": 8, "access": 16, "hex": 32}
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}"
HEX = rf"[0-9a-f]{{{LEAST['hex']},}}"
KINDS = ("assign", "access", "hex", "id", "secret")

# Weak parts.
IDENTIFIER = (r"""(?i:\b(?:(?:aws_)?access_?key(?:_?id)?|client_?id|user(?:_?name|_?id)?|login|account(?:_?id)?))"""
              r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""")
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
ENDPOINT = (r"""(?i:\b(?:https?|ftps?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s"'<>]+"""
            r"""|\b(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,})""")
SCOPE = 200     # characters around a part in which its complement must lie
_CELL = 512
_RUN = 128
MANY_RUNS = 64  # from so many redacted runs on a text is cut from a list of its characters


def _named(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def _before(lengths: Column) -> Column:
    """Sums of all earlier elements, in runs so that long arrays take linear time."""
    def of(a: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / _RUN).cast("int")),
                           lambda r: _sum(F.slice(a, r * _RUN + 1, _RUN)))
        heads = _named(runs, lambda s: F.transform(s, lambda _, r: _sum(F.slice(s, F.lit(1), r))))
        return _named(heads, lambda h: F.transform(a, lambda _, i: F.get(h, F.floor(i / _RUN).cast("int")) + _sum(
            F.slice(a, i - i % _RUN + 1, i % _RUN))))

    return _named(lengths, of)


def spans(text: Column, pattern: str, keep=None, group: int = 0) -> Column:
    """Array of (start, end), in characters, of the leftmost non-overlapping matches of a pattern for which
    ``keep`` holds of the match, or of one of its groups.

    What lies between matches, from a split by the same pattern, gives their places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def placed(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.length(g) + F.length(h))
        ends = _named(steps, lambda s: F.zip_with(_before(s), s, lambda b, n: b + n))
        out = F.zip_with(hits, ends, lambda h, e: F.struct((e - F.length(h)).alias("start"), e.alias("end"),
                                                           h.alias("match")))
        if keep is None:
            return out
        if not group:
            return F.filter(out, lambda s: keep(s["match"]))
        both = F.zip_with(out, words, lambda s, w: F.struct(s.alias("span"), w.alias("word")))
        return F.transform(F.filter(both, lambda b: keep(b["word"])), lambda b: b["span"])

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.transform(_named(found, lambda hits: F.when(F.size(hits) > 0, placed(hits)).otherwise(none)),
                       lambda s: F.struct(s["start"], s["end"]))


def _mixed(word: Column) -> Column:
    """A string with capitals, small letters and digits."""
    return word.rlike("[0-9]") & word.rlike("[a-z]") & word.rlike("[A-Z]")


def parts(text: Column) -> dict[str, Column]:
    """All spans by kind: base, identifiers, secret-like strings and endpoints."""
    return {"assign": spans(text, ASSIGN, lambda m: F.length(m) >= LEAST["assign"], 2),
            "access": spans(text, ACCESS), "hex": spans(text, HEX), "id": spans(text, IDENTIFIER),
            "secret": spans(text, SECRET, _mixed), "endpoint": spans(text, ENDPOINT)}


def _joined(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """The intervals of ``left`` with one of ``right`` within ``scope`` characters.

    Both are listed in the cells they reach; a cell holds few parts, as those of a kind never overlap.
    Nothing is paired out: a semi join on the cell only asks whether there is one.
    """
    def cells(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / _CELL), F.floor(last / _CELL)))

    l = left.withColumn("cell", cells(F.col("start") - scope, F.col("end") + scope)).alias("l")
    r = right.select("key", "start", "end", cells(F.col("start"), F.col("end")).alias("cell")).alias("r")
    on = ((F.col("l.key") == F.col("r.key")) & (F.col("l.cell") == F.col("r.cell"))
          & (F.col("r.start") <= F.col("l.end") + scope) & (F.col("r.end") >= F.col("l.start") - scope))
    return l.join(r, on, "left_semi").select("key", "start", "end", "kind").distinct()


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts with a complement in scope, as ``key`` and the array ``linked`` of (start, kind, end).

    ``found`` has a ``key`` of the text and an array column per kind. Copies of a text are folded first.
    """
    some = found.filter((F.size("secret") + F.size("id") > 0)
                        & (F.size("secret") + F.size("assign") + F.size("hex") > 0)
                        & (F.size("id") + F.size("access") + F.size("endpoint") > 0))
    def of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                    F.lit(kind).alias("kind")))

    listed = F.concat(*map(of, (*KINDS, "endpoint")))
    rows = some.select("key", F.explode(listed).alias("p")).select("key", "p.*").distinct()
    secrets = _joined(rows.filter("kind = 'secret'"), rows.filter("kind IN ('id', 'access', 'endpoint')"), scope)
    ids = _joined(rows.filter("kind = 'id'"), rows.filter("kind IN ('secret', 'assign', 'hex')"), scope)
    return (secrets.unionByName(ids).groupBy("key").agg(F.collect_list(F.struct(
        "start", F.when(F.col("kind") == "id", KINDS.index("id")).otherwise(KINDS.index("secret")).alias("kind"),
        "end")).alias("linked")))


def find_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Add ``base_spans`` and ``spans``, arrays of (start, kind, end) sorted by start, then kind.

    ``kind`` is a place in KINDS, offsets count characters, ends are exclusive. A null or empty text has none;
    equal texts have equal spans; rows and other columns stay as they are.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    names = [c for c in docs.columns if c not in ("base_spans", "spans")]
    found = docs.select(F.struct(*names).alias("row"), F.md5(raw.cast("binary")).alias("key"), F.struct(*[
        spans.alias(kind) for kind, spans in parts(raw).items()]).alias("parts"))

    def numbered(kind: str) -> Column:
        return F.transform(f"parts.{kind}", lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    more = linked(found.select("key", "parts.*"), scope).select(F.col("key").alias("linked_key"), "linked")
    base = found.select("row", "key", F.array_sort(F.concat(*map(numbered, LEAST))).alias("base_spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return (base.join(more, F.col("key") == F.col("linked_key"), "left")
            .select("row.*", "base_spans", F.array_sort(F.concat("base_spans", F.coalesce("linked", none))).alias("spans")))


def listed(spans: str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: str, spans: str, mark: str = "<SECRET>") -> Column:
    """The text with each run of overlapping spans replaced by a mark.

    Of spans sorted by start, the i-th opens a run if the i smallest ends are not after its start: these are then the ends
    of all earlier spans. A text with many runs is cut from its characters, listed once.
    """
    def of(a: Column, ends: Column) -> Column:
        gaps = F.filter(F.transform(a, lambda s, i: F.struct(
            F.coalesce(F.get(ends, i - 1), F.lit(0)).alias("from"), s["start"].alias("to"))), lambda r: r["from"] <= r["to"])
        tail = F.array(F.struct(F.element_at(ends, -1).alias("from"), F.length(F.col(text)).alias("to")))
        return _named(F.concat(gaps, tail), lambda g: F.when(F.size(g) < MANY_RUNS, F.array_join(
            F.transform(g, lambda r: F.substring(F.col(text), r["from"] + 1, r["to"] - r["from"])), mark)).otherwise(
            _named(F.split(F.col(text), ""), lambda c: F.array_join(F.transform(
                g, lambda r: F.array_join(F.slice(c, r["from"] + 1, r["to"] - r["from"]), "")), mark))))

    ends = F.array_sort(F.transform(spans, lambda s: s["end"]))
    cut = _named(F.struct(F.col(spans).alias("a"), ends.alias("ends")), lambda x: of(x["a"], x["ends"]))
    return F.when(F.size(spans) == 0, F.col(text)).otherwise(cut)
