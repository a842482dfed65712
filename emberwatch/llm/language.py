"""Language of pages by fusing evidence.

Three kinds of evidence about a page are put together by Bayes' rule:

* its text: likelihood of its letter trigrams, counted over all documents of each language;
* the language its markup declares: how often pages whose text is in a language declare it;
* its address: a prior for its host, smoothed towards its domain, that towards the address
  suffix, and that towards all pages. All of these are grouped sums.

A page without a trigram says nothing about its language by its text, and is not counted for
any. A page's own text is taken out of the counts of its host before they serve as its prior.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from emberwatch.llm import hashing
from emberwatch.llm.common import kept, sized


@dataclass(frozen=True)
class Settings:
    #: Bits of the hash of a trigram; bounds the model.
    hash_bits: int = 16
    #: Trigrams overlap, so their evidence is not independent: at most this many count.
    most_evidence: float = 60.0
    smoothing: float = 0.5
    #: Pages that the next level up is worth in the counts of a host, domain or suffix.
    weight: float = 5.0


_BLOCK = re.compile(r"<(script|style|nav)\b", re.I)
_CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "nav")}
#: A tag that begins inside another is looked at from its own start only, so no page is read twice.
_DECLARED = r"(?i)<html\b(?:(?!<html\b)[^>])*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})"


def text_of(html):
    """The page with a space for each comment, script, style, navigation block and tag.

    One pass: an end that was looked for in vain is not looked for again, so a page of openings
    without ends takes no longer than any other. What begins like a comment or block but does not
    end is a tag; what begins like a tag but does not end is text.
    """
    parts, at, lacking = [], 0, set()
    while True:
        start = html.find("<", at)
        close = html.find(">", start + 1) if start >= 0 else -1
        if close < 0:
            parts.append(html[at:])
            return "".join(parts)
        end = close + 1
        if html.startswith("<!--", start) and "comment" not in lacking:
            found = html.find("-->", start + 4)
            if found >= 0:
                end = found + 3
            else:
                lacking.add("comment")
        elif (block := _BLOCK.match(html, start)) and (name := block[1].lower()) not in lacking:
            found = _CLOSING[name].search(html, block.end()) if name in _CLOSING else None
            if found:
                end = found.end()
            else:
                lacking.add(name)
        parts += [html[at:start], " "]
        at = end


def _trigrams(column, bits):
    """For slices of rows: first row, count, (row, hashed trigram) of letters in lower case."""
    data, offsets = hashing.column_bytes(column)
    for first, last in hashing.row_slices(offsets):
        part = data[offsets[first] : offsets[last]]
        row = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
        if len(part) < 3:
            yield first, last - first, row[:0], row[:0]
            continue
        letter = hashing.LOWER[part].astype(np.uint32)
        letter[hashing.BETWEEN_TERMS[part] | ((part >= 48) & (part <= 57))] = 32
        codes = letter[:-2] << 16 | letter[1:-1] << 8 | letter[2:]
        useful = (row[:-2] == row[2:]) & (codes != 0x202020)
        hashes = (codes[useful].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        yield first, last - first, row[:-2][useful], hashes.astype(np.int64)


def _language_counts(bits):
    def rows(batches):
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            known, number = np.unique(names.astype(str), return_inverse=True)
            counts = np.zeros((len(known), 1 << bits), np.int64)
            for first, _, row, terms in _trigrams(batch.column("text"), bits):
                keys = number[first + row] << bits | terms
                counts += np.bincount(keys, minlength=counts.size).reshape(counts.shape)
            lang, term = np.nonzero(counts)
            columns = [pa.array(known[lang].tolist(), pa.string()), pa.array(term.astype(np.int32)), pa.array(counts[lang, term])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "seen"])

    return rows


def learn_texts(docs, settings=None):
    """Languages and the log-probabilities of hashed trigrams in each, from all ``docs``
    (text, lang). Documents without a language or text teach nothing."""
    settings = settings or Settings()
    taught = docs.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = taught.mapInArrow(_language_counts(settings.hash_bits), "lang string, term int, seen long").groupBy("lang", "term").agg(F.sum("seen").alias("seen"))
    table = counts.toArrow().to_pandas()  # languages times 2**hash_bits rows at most
    languages = sorted(table["lang"].unique())
    seen = np.full((len(languages), 1 << settings.hash_bits), settings.smoothing)
    for number, name in enumerate(languages):
        own = table[table["lang"] == name]
        seen[number, own["term"].to_numpy()] += own["seen"].to_numpy()
    return languages, np.log(seen / seen.sum(axis=1, keepdims=True))


def _read_pages(broadcast, settings):
    def rows(batches):
        languages, logs = broadcast.value
        for batch in batches:
            texts = [text_of(html) if html else "" for html in batch.column("html").to_pylist()]
            scores = np.zeros((len(texts), len(languages)))
            read = np.zeros(len(texts), bool)
            for first, count, row, terms in _trigrams(pa.array(texts, pa.string()), settings.hash_bits):
                totals = np.stack([np.bincount(row, log[terms], count) for log in logs], 1)
                seen = np.bincount(row, minlength=count)
                read[first : first + count] = seen > 0
                scores[first : first + count] = totals * np.minimum(1, settings.most_evidence / np.maximum(seen, 1))[:, None]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(languages), pa.int32()), pa.array(scores.ravel()))
            arrays = [column for column, name in zip(batch.columns, batch.schema.names) if name != "html"]
            yield pa.RecordBatch.from_arrays([*arrays, lists, pa.array(read)], [*[n for n in batch.schema.names if n != "html"], "text_scores", "has_text"])

    return rows


def _counts(languages):
    return F.array(*[F.sum(F.when(F.col("text_lang") == name, 1.0).otherwise(0.0)) for name in languages])


def _summed(languages):
    return F.array(*[F.sum(F.col("own")[number]) for number in range(len(languages))])


def _smoothed(own, above, weight):
    total = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(own, above, lambda n, p: (n + weight * p) / (total + weight))


def identify(pages, docs, settings=None):
    """Language of every row of ``pages`` (page_id, url, html), taught by ``docs`` (text, lang).

    Gives page_id, host, declared, text_lang (by the text alone), lang and probability. A
    page without text, declaration or address has less evidence, not none: its prior
    remains, and its text_lang is null if its text has no trigram. If no document has a language, lang and probability are null. Of equally
    probable languages the first by name is taken. Repeated rows get equal results; an empty
    table gives no rows; other columns are ignored.
    """
    settings = settings or Settings()
    spark = pages.sparkSession
    languages, logs = learn_texts(docs, settings)
    address = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    rows = pages.select("page_id", address.alias("host"), F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), _DECLARED, 1)).alias("declared"), "html")
    if not languages:
        return rows.select("page_id", "host", "declared", *[F.lit(None).cast(k).alias(n) for n, k in (("text_lang", "string"), ("lang", "string"), ("probability", "double"))])
    model = spark.sparkContext.broadcast((languages, logs))
    read = rows.mapInArrow(_read_pages(model, settings), "page_id long, host string, declared string, text_scores array<double>, has_text boolean")
    names = F.array(*[F.lit(name) for name in languages])
    best = F.when(F.col("has_text"), names[F.array_position("text_scores", F.array_max("text_scores")).cast("int") - 1])
    declared = F.when(F.col("declared").isin(languages), F.col("declared")).when(F.col("declared") == "", "").otherwise("other")
    read = read.withColumn("text_lang", best).withColumn("said", declared)
    read = read.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1))
    read = kept(read)

    # grouped sums from the bottom up, smoothing from the top down
    hosts = kept(read.groupBy("host", "domain", "suffix").agg(_counts(languages).alias("own")))
    domains = kept(hosts.groupBy("domain", "suffix").agg(_summed(languages).alias("own")))
    suffixes = kept(domains.groupBy("suffix").agg(_summed(languages).alias("own")))
    everything = suffixes.agg(_summed(languages)).first()
    total = np.array(everything[0] if everything and everything[0] and everything[0][0] is not None else [0.0] * len(languages)) + settings.smoothing
    overall = F.array(*[F.lit(float(share)) for share in total / total.sum()])
    weight = F.lit(settings.weight)
    suffix_prior = suffixes.select("suffix", _smoothed(F.col("own"), overall, weight).alias("above"))
    domain_prior = domains.join(sized(suffix_prior), "suffix").select("domain", "suffix", _smoothed(F.col("own"), F.col("above"), weight).alias("above"))
    host_prior = kept(hosts.join(sized(domain_prior), ["domain", "suffix"]).select("host", "own", "above"))

    said = kept(read.filter("text_lang IS NOT NULL").groupBy("text_lang", "said").count())
    table = {(row["text_lang"], row["said"]): row["count"] for row in said.collect()}  # languages squared, about
    kinds = ["", "other", *languages]

    def declared_log(kind, name):
        seen = sum(table.get((name, other), 0) for other in kinds)
        return float(np.log((table.get((name, kind), 0) + settings.smoothing) / (seen + settings.smoothing * len(kinds))))

    logs_said = F.array(*[F.lit(0.0) for _ in languages])
    for kind in kinds:
        logs_said = F.when(F.col("said") == kind, F.array(*[F.lit(declared_log(kind, name)) for name in languages])).otherwise(logs_said)
    joined = read.join(sized(host_prior), "host")
    others = F.zip_with("own", names, lambda n, name: n - F.when(name.eqNullSafe(F.col("text_lang")), 1.0).otherwise(0.0))
    prior = F.transform(_smoothed(others, F.col("above"), weight), lambda p: F.log(p))
    add = lambda a, b: a + b
    joined = joined.withColumn("logs", F.zip_with(F.zip_with("text_scores", logs_said, add), prior, add))
    odds = F.transform("logs", lambda value: F.exp(value - F.array_max("logs")))
    joined = joined.withColumn("probability", F.lit(1.0) / F.aggregate(odds, F.lit(0.0), add))
    lang = names[F.array_position("logs", F.array_max("logs")).cast("int") - 1].alias("lang")
    return joined.select("page_id", "host", "declared", "text_lang", lang, "probability")
