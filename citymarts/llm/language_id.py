"""Language of documents by fusing evidence in Bayes' rule.

posterior(language) ~ prior(language | host) x P(declared language | language)
x P(text | language)

* Text: hashed byte trigrams (ASCII letters lower-cased, other ASCII as one
  blank), one smoothed distribution per declared language, counted over the
  whole corpus by grouped aggregation.
* Declared language (markup attribute or a metadata column): right with a
  fixed reliability, else spread evenly.
* Prior: shares of declared languages per host, smoothed towards those of the
  host's address suffix, which are smoothed towards those of the corpus; all
  from one grouped count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import byte_column, prepare, runs_of_rows, save

BUCKETS = 1 << 14
#: Languages whose trigrams a task counts before it passes them on, and cells of documents x languages scored at once.
HELD_LANGUAGES = 64
HELD_SCORES = 1 << 20
#: Two-letter codes of languages (ISO 639-1, with withdrawn ones).
TWO_LETTERS = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr "
    "fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik in io is it iu iw ja ji jv jw ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la "
    "lb lg li ln lo lt lu lv mg mh mi mk ml mn mo mr ms mt my na nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc "
    "sd se sg sh si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
).split()
#: Three-letter codes (ISO 639-2 and 639-3) of languages that have no two-letter code and are common in web corpora.
THREE_LETTERS = (
    "ace ang arc arz ast awa azb bar bcl bho bjn bpy bug bxr cdo ceb chr ckb cmn csb diq dsb eml ext fil frr fur gag glk gom gsw hak haw hif hil "
    "hsb ilo jbo kaa kab kbd koi krc ksh lad lez lij lmo lrc ltg mai map mdf mhr min mrj mwl myv mzn nah nan nap nds new nov nso pag pam pap pcd "
    "pfl pms pnb rue sah scn sco sat shn szl tet tpi tum tyv udm vec vep vls vro war wuu xal xmf yue zea"
).split()
#: Three-letter codes that mean the same as a two-letter one.
SAME = dict(
    pair.split("=")
    for pair in (
        "afr=af alb=sq ara=ar arm=hy aze=az baq=eu bel=be ben=bn bos=bs bul=bg bur=my cat=ca ces=cs chi=zh cym=cy cze=cs dan=da deu=de dut=nl ell=el "
        "eng=en est=et eus=eu fas=fa fin=fi fra=fr fre=fr geo=ka ger=de gle=ga glg=gl gre=el guj=gu heb=he hin=hi hrv=hr hun=hu hye=hy ice=is ind=id "
        "isl=is ita=it jpn=ja kan=kn kat=ka kaz=kk khm=km kor=ko lao=lo lat=la lav=lv lit=lt ltz=lb mac=mk mal=ml mar=mr may=ms mkd=mk mon=mn msa=ms "
        "mya=my nep=ne nld=nl nno=nn nob=nb nor=no pan=pa per=fa pol=pl por=pt ron=ro rum=ro rus=ru sin=si slk=sk slo=sk slv=sl som=so spa=es sqi=sq "
        "srp=sr swa=sw swe=sv tam=ta tel=te tgl=tl tha=th tur=tr ukr=uk urd=ur uzb=uz vie=vi wel=cy zho=zh zul=zu"
    ).split()
)
LANGUAGES = TWO_LETTERS + THREE_LETTERS
#: Weight, in rows, of the level above when shares are smoothed.
SMOOTHING = 20.0
RELIABILITY = 0.9
#: Trigrams overlap and repeat: a text counts as this many independent ones at most.
EVIDENCE = 120
MIN_CONFIDENCE = 0.5
CHUNK = 1 << 20

_FOLD = np.full(256, 32, np.uint32)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def trigrams(raw: np.ndarray, off: np.ndarray):
    """``(document, bucket)`` of every byte trigram with at least one letter, inside documents."""
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = _FOLD[raw]
    code = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    good = (row[:-2] == row[2:]) & (code != 0x202020)
    code = code[good] * np.uint32(2654435761)
    return row[:-2][good], (code >> np.uint32(18)).astype(np.int64)


def lettered(col) -> np.ndarray:
    """Whether each text has a letter, also one too short for a trigram."""
    raw, off = byte_column(col)
    out = np.zeros(len(off) - 1, bool)
    for i, j in runs_of_rows(off, CHUNK):
        seen = np.append(0, np.cumsum(_FOLD[raw[off[i] : off[j]]] != 32))
        out[i:j] = np.diff(seen[off[i : j + 1] - off[i]]) > 0
    return out


def _chunks(col, rows: int = 1 << 62):
    raw, off = byte_column(col)
    for first, last in runs_of_rows(off, CHUNK):
        for i in range(first, last, rows):
            j = min(last, i + rows)
            yield i, j, trigrams(raw[off[i] : off[j]], off[i : j + 1] - off[i])


class Evidence:
    """What the corpus says: languages, their shares, and trigram distributions.

    A distribution is a level for unseen buckets and a (bucket, value) row for
    each seen one; those of language ``i`` stand from ``ends[i]`` to ``ends[i + 1]``.
    """

    def __init__(self, languages: list[str], shares: np.ndarray, lang: np.ndarray, bucket: np.ndarray, n: np.ndarray):
        self.languages, self.shares = languages, shares
        order = np.argsort(lang, kind="stable")
        lang, n = lang[order], n[order]
        total = np.bincount(lang, weights=n, minlength=len(languages)) + BUCKETS
        self.ends = np.searchsorted(lang, np.arange(len(languages) + 1))
        self.bucket = bucket[order].astype(np.uint16)
        self.unseen = np.log(1 / total).astype(np.float32)
        self.value = np.log((1 + n) / total[lang]).astype(np.float32)

    def logp(self, i: int) -> np.ndarray:
        """Log probabilities of all buckets in language ``i``."""
        out, own = np.full(BUCKETS, self.unseen[i]), slice(self.ends[i], self.ends[i + 1])
        out[self.bucket[own]] = self.value[own]
        return out


def evidence_rows(
    df: DataFrame, text: Column, declared: Column, host: Column | None, suffix: Column | None, keep: list[str], languages: list[str] = LANGUAGES
) -> DataFrame:
    """``keep`` and ``_text``, ``_declared`` (lower-case primary subtag, shortened by ``SAME``, NULL if not in ``languages``), ``_host``, ``_suffix``."""
    tag = F.lower(F.regexp_extract(F.trim(declared.cast("string")), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    same = F.create_map(*(F.lit(z) for pair in SAME.items() for z in pair))
    tag = F.coalesce(same[tag], tag)
    none = F.lit(None).cast("string")
    return df.select(
        *keep,
        text.cast("string").alias("_text"),
        F.when(tag.isin(languages), tag).alias("_declared"),
        (none if host is None else F.lower(host)).alias("_host"),
        (none if suffix is None else F.lower(suffix)).alias("_suffix"),
    )


def gather(rows: DataFrame) -> tuple[Evidence, DataFrame]:
    """Evidence of the whole corpus, and the prior (array of log shares) of every host."""
    counts = save(rows.where("_declared is not null").groupBy("_suffix", "_host", "_declared").count(), "language-counts")
    total = counts.groupBy("_declared").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "_declared").collect()
    languages = [r[0] for r in total]
    shares = np.array([float(r.n) for r in total])
    shares = shares / shares.sum() if len(shares) else shares

    def count(batches):
        seen = {name: i for i, name in enumerate(languages)}
        held = {}

        def counted():
            for lang, sums in held.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), lang, np.int32)), pa.array(at.astype(np.int32)), pa.array(sums[at])], names=["lang", "bucket", "n"]
                )
            held.clear()

        for b in batches:
            own = np.array([seen[x] for x in b.column(1).to_pylist()], np.int64)
            for i, j, (row, bucket) in _chunks(b.column(0)):
                present, local = np.unique(own[i:j], return_inverse=True)
                which = local[row]
                for k in range(0, len(present), HELD_LANGUAGES):
                    some = present[k : k + HELD_LANGUAGES]
                    use = slice(None) if len(some) == len(present) else (which >= k) & (which < k + len(some))
                    sums = np.bincount((which[use] - k) * BUCKETS + bucket[use], minlength=len(some) * BUCKETS).reshape(-1, BUCKETS)
                    for lang, more in zip(some.tolist(), sums):
                        held[lang] = held[lang] + more if lang in held else more.copy()
                    if len(held) >= HELD_LANGUAGES:
                        yield from counted()
        yield from counted()

    sums = rows.where("_declared is not null").select("_text", "_declared").mapInArrow(count, "lang int, bucket int, n long")
    # at most one number for each bucket that occurs in a declared language reaches the driver
    got = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    known = Evidence(languages, shares, *(got[c].to_numpy() for c in ("lang", "bucket", "n")))

    def level(*by):
        per = counts.groupBy(*by, "_declared").agg(F.sum("count").alias("count"))
        return per.groupBy(*by).agg(F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("_declared", "count"))).alias("_per"))

    def smooth(above, then=lambda x: x):
        return F.transform(
            listed(languages), lambda x, i: then((F.coalesce(F.col("_per")[x], F.lit(0)) + SMOOTHING * F.get(above, i)) / (F.col("n") + SMOOTHING))
        )

    by_suffix = level("_suffix").select("_suffix", smooth(listed(shares, "double")).alias("_above"))
    hosts = level("_suffix", "_host").withColumnsRenamed({"_suffix": "_s", "_host": "_h"})
    hosts = hosts.join(by_suffix, F.col("_s").eqNullSafe(F.col("_suffix")))
    return known, hosts.select("_s", "_h", smooth(F.col("_above"), F.log).alias("_prior"))


def listed(values, kind: str = "string") -> Column:
    """A constant array of ``values`` that stays one node of the plan however many they are."""
    joined = ",".join(map(str, values))
    return (F.split(F.lit(joined), ",") if joined else F.array()).cast(f"array<{kind}>")


def identify(
    df: DataFrame, keep: list[str], text: Column, declared: Column, host: Column | None = None, suffix: Column | None = None,
    min_confidence: float = MIN_CONFIDENCE, languages: list[str] = LANGUAGES,
) -> DataFrame:
    """``keep`` columns with ``language``, ``confidence`` (its posterior) and ``kept``.

    A row is rejected if its text (NULL: empty) has no letter to judge by, in
    which case its language is NULL, or if no language reaches
    ``min_confidence``. A text too short for a trigram is judged by the other evidence. Unknown hosts fall back to their suffix's shares or the
    corpus's, NULL declared languages and codes of no language say nothing.
    Every declared language of ``languages`` is told apart; other codes are unknown, so
    that what reaches the driver and the tasks is bounded by that list (by default
    some 290 codes of 16384 trigram buckets each) and not by what pages declare.
    A text weighs as much as ``EVIDENCE`` of its trigrams, so that a long text
    does not drown the declared language and the host. Equal posteriors go to the language declared more often. A corpus that declares no language
    rejects all. Repeated rows stay; names in ``keep`` must not start with an underscore.
    """
    prepare(df.sparkSession)
    rows = evidence_rows(df, text, declared, host, suffix, keep, languages)
    known, priors = gather(rows)
    size = len(known.languages)
    kept_type = rows.select(*keep, "_declared", "_host", "_suffix").schema
    width = len(kept_type)

    def judge(batches):
        for b in batches:
            seen = pa.array(lettered(b.column(width)))
            for i, j, (row, bucket) in _chunks(b.column(width), max(1, HELD_SCORES // max(1, size))):
                n = np.bincount(row, minlength=j - i)
                scale = np.minimum(n, EVIDENCE) / np.maximum(n, 1)
                like = np.zeros((j - i, size))
                for k in range(size):
                    like[:, k] = np.bincount(row, weights=known.logp(k)[bucket], minlength=j - i) * scale
                ends = pa.array(np.arange(j - i + 1, dtype=np.int32) * size)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(width)] + [pa.ListArray.from_arrays(ends, pa.array(like.reshape(-1))), seen.slice(i, j - i)],
                    names=names,
                )

    schema = rows.select(*keep, "_declared", "_host", "_suffix").schema
    names = [*schema.names, "_like", "_seen"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    judged = rows.select(*schema.names, "_text").mapInArrow(judge, f"{ddl}, _like array<double>, _seen boolean")
    both = F.col("_host").eqNullSafe(F.col("_h")) & F.col("_suffix").eqNullSafe(F.col("_s"))
    flat = listed((math.log(s) for s in known.shares), "double")
    scored = judged.join(priors, both, "left").withColumn("_p", F.coalesce("_prior", flat))
    if not size:
        return scored.select(*keep, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    wrong = math.log((1 - RELIABILITY) / max(1, size - 1))
    languages = listed(known.languages)
    own = F.array_position(languages, F.col("_declared")) - 1
    said = F.when(F.col("_own").isNull(), 0.0)
    terms = F.transform(
        F.zip_with("_p", "_like", lambda p, x: p + x),
        lambda x, i: x + said.when(i == F.col("_own"), math.log(RELIABILITY)).otherwise(wrong),
    )
    scored = scored.withColumn("_own", own).withColumn("_t", terms).withColumn("_top", F.array_max("_t"))
    share = 1 / F.aggregate("_t", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("_top")))
    best = F.element_at(languages, F.array_position("_t", F.col("_top")).cast("int"))
    seen = F.col("_seen")
    return scored.select(*keep, F.when(seen, best).alias("language"), share.alias("confidence"), (seen & (share >= min_confidence)).alias("kept"))


def page_columns(html: str = "html", url: str = "url") -> tuple[Column, Column, Column, Column]:
    """``(text, declared, host, suffix)`` of raw pages: text without markup, the
    ``lang`` attribute of the html element, and the host of the address with its last label."""
    body = F.regexp_replace(F.col(html), "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract(F.col(url), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    host = F.when(host != "", host)
    return (
        F.coalesce(body, F.lit("")),
        F.regexp_extract(F.col(html), "(?is)<html\\b[^>]*?\\slang\\s*=\\s*[\"']?([A-Za-z_-]+)", 1),
        host,
        F.regexp_extract(host, "([^.]+)$", 1),
    )
