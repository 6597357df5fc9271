"""Operator 1: secret scan with rules and character Markov models, DataFrame
and SQL functions only.

Two first-order Markov chains over characters, one of random strings and one
of ordinary identifiers, are trained from labelled samples; a token whose
log-likelihood ratio passes a threshold is reported besides what the fixed
rules find. Unless other samples are given they are ``labelled_samples``,
made by a rule, so the model does not depend on the table that is scanned.

Positions are running sums over a text's matches. They are taken in chunks of
CHUNK matches (a sum per chunk, a short running sum over the chunks, then
inside each), as appending to an array copies it: the work grows in proportion
to the matches of a text.
"""

from __future__ import annotations

import json
import math
import random
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.llm.common import keep

# Fixed patterns of the base rules. The {n,} forms of access and hex keep the
# same spans as the + form with a length check, since a run is taken whole.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}"
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("token", TOKEN))
ALPHABET = string.ascii_letters + string.digits + "+/_=-."
MIN_TOKEN = 16
# Nats by which the random model has to be the likelier one.
THRESHOLD = 10.0
BACKOFF = 4.0

CHUNK = 256
_SPAN = "array<struct<s:int,e:int,v:string>>"

# Ordinary words of the labelled samples: what identifiers are made of, and
# long words of languages that write compounds.
PARTS = ("""
access account action address amount archive array author backup balance batch border branch buffer build button cache calendar category center channel check class client cluster code collection
column command company config connection content context count country currency customer database
default delivery description device directory document download editor element empty error event
example factory feature field filter folder format function gateway group handler header height
history image index initial instance interface journal language length library limit
local location machine manager member memory message method migration model monitor network
notification number object office option order output package parameter parent person platform price
process product project property public query record region register report request resource response
result schedule schema script search section service session setting signal source storage stream
string subject summary support system table target template thread traffic transfer
upload vector version view 
arbeitszeit aufzeichnung ausschreibung bedeutung beziehungsweise durchschnitt eigenschaft entwicklung
erfahrung gesellschaft gleichzeitig handwerk hauptbahnhof kenntnisse landschaft menschlichkeit
nachrichten oberflaeche pflanzenschutz rechtschreibung schiffahrt schnittpunkt selbstverstaendlich
sprachwissenschaft unterscheidung verantwortlichkeit wirtschaft zeitschrift zukunft zwischenzeit
apprentissage aujourd bibliotheque connaissance developpement environnement fonctionnement gouvernement
heureusement interessant longtemps malheureusement naturellement nouvelle quelquefois renseignement
ayuntamiento conocimiento desarrollo especialmente funcionamiento investigacion movimiento necesidad
posibilidad siguiente trabajadores universidad
""").split()


def labelled_samples(spark: SparkSession, n: int = 4000, seed: int = 1) -> DataFrame:
    """value, random: ``n`` random strings over the alphabets keys come in,
    and ``n`` ordinary identifiers, made of PARTS in the usual ways of
    writing them. The same for every call."""
    r = random.Random(seed)
    alphabets = (string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits,
                 string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits)
    rows = [("".join(r.choices(alphabets[i % 4], k=r.randint(16, 48))), True) for i in range(n)]
    for i in range(n):
        w = r.choices(PARTS, k=r.randint(2, 5))
        style = i % 6
        value = ("_".join(w) if style == 0 else "-".join(w) if style == 1 else
                 w[0] + "".join(x.title() for x in w[1:]) if style == 2 else "/".join(w)
                 if style == 3 else "".join(w) if style == 4 else "_".join(w).upper())
        if r.random() < 0.3:
            value = value[0].upper() + value[1:]
        if r.random() < 0.2:
            value += r.choice("_-/") + str(r.choice((1, 2, 3, 10, 100, 2020, 2024, 8080)))
        rows.append((value, False))
    return spark.createDataFrame(rows, "value string, random boolean")


def _chunked(items: str, start: str, total: str, join: str, local: str) -> str:
    """SQL: a scan over the array ``items`` in chunks. ``start`` is the state
    before the first item; ``total`` is the aggregate of a chunk ``part``,
    which ``join`` adds to the state ``st``; ``local`` is the result array of a
    chunk ``part`` from the state ``st`` before it."""
    part = f"slice({items}, c * {CHUNK} + 1, {CHUNK})"
    return f"""
flatten(transform(
  aggregate(sequence(0, (size({items}) - 1) div {CHUNK}),
            named_struct('st', {start}, 'out', cast(array() AS array<int>)),
            (a, c) -> transform(array({part}), part -> transform(array(a.st), st ->
              named_struct('st', {join.format(total=total)}, 'out', concat(a.out, array(st))))[0])[0]
           ).out,
  (st, c) -> transform(array({part}), part -> {local})[0]))"""


def _located(kind: str) -> Column:
    """Spans (s, e, v) from the gaps and lengths l_kind of the matches, in code
    points."""
    scan = _chunked(
        f"l.{kind}", "0", "aggregate(part, 0, (t, x) -> t + x.g + x.n)", "st + {total}",
        f"""aggregate(part, named_struct('at', st, 'out', cast(array() AS {_SPAN})),
        (a, x) -> named_struct('at', a.at + x.g + x.n, 'out', concat(a.out, array(named_struct(
          's', a.at + x.g, 'e', a.at + x.g + x.n, 'v', x.v))))).out""")
    return F.expr(f"CASE WHEN size(l.{kind}) = 0 THEN cast(array() AS {_SPAN}) ELSE {scan} END")


# Tokens that overlap no base span. Base spans stand at their start, tokens
# ask at their end (before a base span that starts there): one overlaps if
# the largest end so far is beyond the token's start.
_EVENTS = """array_sort(concat(
  transform(concat(assign, access, hex), b -> named_struct('at', b.s, 'base', 1, 'x', b.e, 'i', -1)),
  transform(token, (t, i) -> named_struct('at', t.e, 'base', 0, 'x', t.s, 'i', i))))"""
_FREE = _chunked(
    "ev", "0", "aggregate(part, 0, (t, x) -> if(x.base = 1, greatest(t, x.x), t))",
    "greatest(st, {total})",
    """aggregate(part, named_struct('far', st, 'out', cast(array() AS array<int>)),
       (a, x) -> named_struct('far', if(x.base = 1, greatest(a.far, x.x), a.far),
                              'out', if(x.base = 0 AND a.far <= x.x, concat(a.out, array(x.i)),
                                        a.out))).out""")


def _once(value: Column) -> Column:
    # behind a generator: computed once, not inlined into the lambdas
    return F.explode(F.array(value))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and per kind the spans of every text (null: empty); ``token``
    has the long tokens outside of base spans."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text", _once(F.struct(*[
        F.regexp_extract_all("text", F.lit(rx), F.lit(0)).alias(k) for k, rx in KINDS])).alias("m"))
    rows = rows.select("doc_id", "m", _once(F.struct(*[
        F.when(F.size(F.col(f"m.{k}")) > 0, F.split("text", rx, -1)).alias(k)
        for k, rx in KINDS])).alias("p"))
    lengths = ("transform(m.{0}, (v, i) -> named_struct('g', char_length(p.{0}[i]), "
               "'n', char_length(v), 'v', v))")
    rows = rows.select("doc_id", _once(F.struct(*[
        F.expr(lengths.format(k)).alias(k) for k, _ in KINDS])).alias("l"))
    rows = rows.select("doc_id", _once(F.struct(*[_located(k).alias(k) for k, _ in KINDS])).alias("f"))
    rows = rows.select("doc_id", "f.*").withColumn("assign", F.filter("assign", lambda x: F.length(
        F.regexp_extract(x.v, ASSIGN, 2)) >= 8))
    both = "size(token) > 0 AND size(assign) + size(access) + size(hex) > 0"
    rows = rows.withColumn("ev", _once(F.expr(f"CASE WHEN {both} THEN {_EVENTS} END")))
    rows = rows.withColumn("free", _once(F.expr(f"CASE WHEN {both} THEN {_FREE} END")))
    return rows.withColumn("token", F.expr(
        "CASE WHEN free IS NULL THEN token ELSE transform(free, i -> token[i]) END")).drop("ev", "free")


def weak_samples(found: DataFrame) -> DataFrame:
    """value, random: samples that the rules label in what ``find`` found,
    for ``train``: values they find are random strings, long words of letters
    outside of them are ordinary. On request only: these labels are guesses and
    depend on the table."""
    secret = found.select(F.explode(F.concat("assign", "access", "hex")).alias("x"))
    secret = secret.select(F.when(F.col("x.v").rlike(f"^{ASSIGN}$"),
                                  F.regexp_extract("x.v", ASSIGN, 2))
                           .otherwise(F.col("x.v")).alias("value"), F.lit(True).alias("random"))
    plain = found.select(F.explode("token").alias("x")).filter(
        F.col("x.v").rlike("^[A-Za-z_]+$")).select("x.v", F.lit(False))
    return secret.union(plain)


def train(samples: DataFrame) -> list[float] | None:
    """Log ratios of the transition probabilities (random over ordinary), row
    by row of ALPHABET plus one row and column 0 for other characters.

    Transitions are counted over all ``samples`` (value, random); at most
    two tables of 69 x 69 counts reach the driver. Each chain backs off to its
    character frequencies. None if a class has no transition.
    """
    pairs = samples.filter("length(value) > 1 AND random IS NOT NULL").select(
        "random", F.explode(F.expr(
            "transform(sequence(1, length(value) - 1), i -> substr(value, i, 2))")).alias("ab"))
    index = F.lit(ALPHABET)
    pairs = pairs.select("random", F.instr(index, F.substring("ab", 1, 1)).alias("a"),
                         F.instr(index, F.substring("ab", 2, 1)).alias("b"))
    n = len(ALPHABET) + 1
    count = {True: [[0] * n for _ in range(n)], False: [[0] * n for _ in range(n)]}
    for r in pairs.groupBy("random", "a", "b").count().collect():
        count[r.random][r.a][r.b] = r["count"]
    logs = {}
    for kind, table in count.items():
        total = sum(map(sum, table))
        if not total:
            return None
        to = [(sum(row[b] for row in table) + 0.5) / (total + 0.5 * n) for b in range(n)]
        logs[kind] = [math.log((table[a][b] + BACKOFF * to[b]) / (sum(table[a]) + BACKOFF))
                      for a in range(n) for b in range(n)]
    return [x - y for x, y in zip(logs[True], logs[False], strict=True)]


def scan(docs: DataFrame, model: list[float] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access, n_hex,
    n_markov, base_sha256, spans.

    Base spans are the rules' matches, leftmost and non-overlapping per kind;
    the model (by default trained on ``labelled_samples``) adds tokens of 16 or
    more characters with a letter that overlap none of them, as kind ``markov``. A null text is empty; no spans hash as
    the empty string. Repeated rows give equal rows, no rows give none; other
    columns are ignored.
    """
    model = model or train(labelled_samples(docs.sparkSession))
    found = keep(find(docs))
    rows = found.withColumn("token", F.expr(
        f"filter(token, t -> length(t.v) >= {MIN_TOKEN} AND t.v RLIKE '[A-Za-z]')"))
    rows = rows.withColumn("markov", F.filter("token", lambda t: _passes(t, model, threshold)))

    def labelled(kinds):
        parts = [F.expr(f"transform({k}, x -> struct(x.s AS s, {i} AS k, '{k}' AS kind, x.e AS e))")
                 for i, k in enumerate(kinds)]
        return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: F.concat_ws(
            ":", x.kind, x.s.cast("string"), x.e.cast("string"))), ",")

    base = ("assign", "access", "hex")
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in (*base, "markov")],
        F.sha2(labelled(base), 256).alias("base_sha256"),
        labelled((*base, "markov")).alias("spans"))


def _passes(t: Column, model: list[float], threshold: float) -> Column:
    n = len(ALPHABET) + 1
    table = F.from_json(F.lit(json.dumps([round(x, 6) for x in model])), "array<double>")
    at = lambda i: F.instr(F.lit(ALPHABET), F.substr(t.v, i, F.lit(1)))
    total = F.aggregate(F.sequence(F.lit(2), F.length(t.v)), F.lit(0.0),
                        lambda acc, i: acc + F.get(table, at(i - 1) * n + at(i)))
    return total > threshold
