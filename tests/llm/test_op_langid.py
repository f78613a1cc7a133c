import base64
import functools
import math
import random
from collections import Counter

import numpy as np
from corpus_cases import documents, held_out, odd_texts
from pyspark.sql import functions as F

from skyloom.llm import langid
from skyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()
    found = {r["doc_id"]: r for r in QUERIES["op6_language_id"](spark, SF_DIR).collect()}
    assert set(found) == {r["doc_id"] for r in docs}
    assert all(r["held_out"] == held_out(i) for i, r in found.items())
    assert all(0 <= r["score"] <= 1 for r in found.values())
    own = [r for r in docs if held_out(r["doc_id"])]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in own)
    assert right >= 0.98 * len(own)


def learned(spark):
    english = "the quick brown fox jumps over the lazy dog and runs away from the other dogs "
    german = "der schnelle braune fuchs springt ueber den faulen hund und rennt vor ihm davon "
    rows = []
    for i in range(30):
        rows.append((i, f"{english[i % 9:]} {english[i % 7:40]}", "en"))
        rows.append((100 + i, f"{german[i % 9:]} {german[i % 7:40]}", "de"))
    return rows


def test_odd_texts_and_rejection(spark):
    rows = learned(spark) + [(1000 + i, text) for i, (_, text) in enumerate(odd_texts())]
    rows += [(2000, "the dog and the fox"), (2001, "der hund und der fuchs")]
    rows += [(2002, "12345 67890 !!! ???"), (2003, "шщъыь эюя жзийк лмноп " * 20), (None, "the fox")]
    found = {r["doc_id"]: r for r in langid.identify(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    assert found[2000]["lang_pred"] == found[None]["lang_pred"] == "en"
    assert found[2001]["lang_pred"] == "de"
    assert not found[2000]["rejected"] and not found[2001]["rejected"]
    for i in (1000, 1001, 1002, 2002):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    assert found[2003]["rejected"] and found[2003]["lang_pred"] in ("en", "de")


FOREIGN = {
    "it": "La mattina presto il vecchio pescatore scese lungo la strada verso il porto, dove le barche"
    " dormivano ancora sotto la nebbia. Non aveva fretta, perché sapeva che il mare non aspetta.",
    "pl": "Wczesnym rankiem stary rybak zszedł drogą do portu, gdzie łodzie jeszcze spały pod mgłą. Nie"
    " spieszył się, ponieważ wiedział, że morze na nikogo nie czeka i że każdy dzień coś przynosi.",
    "fi": "Varhain aamulla vanha kalastaja käveli tietä pitkin satamaan, jossa veneet nukkuivat vielä"
    " sumun alla. Hänellä ei ollut kiirettä, sillä hän tiesi, ettei meri odota ketään.",
}


def test_latin_script_of_no_learned_language_goes(spark):
    rng = random.Random(3)

    def words(letters):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 10))) for _ in range(60))

    noise = bytes(rng.getrandbits(8) for _ in range(400))
    gone = [*FOREIGN.values(), words("abcdefghijklmnopqrstuvwxyz"), words("bcdfghjklmnpqrstvwxz")]
    gone += [noise.hex(), noise.hex(" "), noise.hex(" ", 4), base64.b64encode(noise).decode()]
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    rows = [(-1 - i, text, None) for i, text in enumerate(gone)]
    every = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = {r["doc_id"]: r["rejected"] for r in langid.identify(every).collect()}
    assert [i for i in range(len(gone)) if not found[-1 - i]] == []
    own = [r for r in docs.where("length(text) > 0 AND lang IS NOT NULL").collect() if held_out(r["doc_id"])]
    assert sum(found[r["doc_id"]] for r in own) <= 0.002 * len(own)
    short = [r for r in own if 10 <= len(r["text"]) < 60]
    assert short and sum(found[r["doc_id"]] for r in short) <= 0.01 * len(short)


def test_held_out_rows_teach_nothing(spark):
    away = [i for i in range(200) if held_out(i)]
    rows = learned(spark) + [(1000 + i, "une autre langue", "fr") for i in range(200)
                             if held_out(1000 + i)]
    assert away and langid.fit(documents(spark, rows)).languages == ["de", "en"]


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some text"), (2, None)])
    assert {tuple(r) for r in langid.identify(docs).select("lang_pred", "rejected").collect()} == {
        ("und", True)
    }
    assert langid.identify(documents(spark, [])).count() == 0


def test_kept_rows_keep_their_columns(spark):
    docs = documents(spark, learned(spark) + [(500, "123"), (500, "123"), (None, None)])
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in learned(spark)}


def test_repeated_and_null_ids_give_one_model_for_any_partitioning(spark):
    rows = learned(spark) + [(i, text[5:], lang) for i, text, lang in learned(spark)[:20]]
    rows += [(None, f"the dog {i} and the fox " * (1 + i % 3), "en") for i in range(20)]
    rows += [(3000 + i, text) for i, (_, text, _) in enumerate(learned(spark)[::7])]
    found = []
    for parts in (1, 3, 7):
        done = langid.identify(documents(spark, rows).repartition(parts)).collect()
        found.append(sorted(map(str, ((r["doc_id"], r["lang_pred"], round(r["score"], 5)) for r in done))))
    assert found[0] == found[1] == found[2]


def plain_counts(text):
    """How often a text's n-grams of letters, all else a space, fall into each bucket; runs of letters."""
    data = [b if b > 127 else b | 32 if chr(b).isalpha() else 32 for b in text.encode()]
    found = {}
    for n in langid.ORDERS:
        for i in range(len(data) - n + 1):
            code = 0
            for byte in data[i : i + n]:
                code = (code * 0x01000193 + byte) % 2**32
            bucket = (code + n) * 0x9E3779B1 % 2**32 * langid.BUCKETS // 2**32
            found[bucket] = found.get(bucket, 0) + 1
    letters = [b != 32 for b in data]
    begins = sum(now and not before for before, now in zip([False, *letters], letters))
    return found, sum(letters), sum(letters) / max(begins, 1)


def plain_unit(weights):
    length = math.sqrt(sum(w * w for w in weights.values()))
    return {k: w / length for k, w in weights.items()}


def plain_dot(a, b):
    return sum(w * b.get(k, 0.0) for k, w in a.items())


def plain_centroids(rows):
    chosen = [0]
    while len(chosen) < min(langid.CENTROIDS, len(rows)):
        nearest = [max(plain_dot(r, rows[c]) for c in chosen) for r in rows]
        chosen.append(nearest.index(min(nearest)))
    centroids = [rows[c] for c in chosen]
    for _ in range(langid.ROUNDS):
        sums = [{} for _ in centroids]
        for row in rows:
            cosines = [plain_dot(row, c) for c in centroids]
            total = sums[cosines.index(max(cosines))]
            for k, w in row.items():
                total[k] = total.get(k, 0.0) + w
        centroids = [plain_unit(s) if s else c for s, c in zip(sums, centroids)]
    return centroids


def plain_beginning(text, size):
    seen = 0
    for place, byte in enumerate(text.encode()):
        if chr(byte).isalpha() and byte < 128 or byte > 127:
            seen += 1
            if seen == size:
                cut = place + 1
            if seen > size:
                return text.encode()[:cut].decode(errors="ignore")
    return None


def test_whole_results_against_a_plain_version(spark):
    """Frequencies, centroids, floors, cosines and rejections, worked out with dictionaries."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.select("doc_id", F.substring("text", 1, 400).alias("text"), "lang").where("doc_id < 220")
    odd = [(9000, "12 34"), (9001, ""), (9002, None), (9003, "шщъыь эюя " * 9), (9004, "a1 b2 " * 40), (9005, "the")]
    docs = docs.unionByName(spark.createDataFrame([(*r, None) for r in odd], "doc_id long, text string, lang string"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2**31)).alias("draw")
    rows = docs.select("*", draw).collect()
    taught = [r for r in rows if r["lang"] and not held_out(r["doc_id"]) and langid.has_letter(r["text"])]
    taught.sort(key=lambda r: r["draw"])

    holders = Counter(b for r in taught for b in plain_counts(r["text"])[0])
    idf = {b: math.log((1 + len(taught)) / (1 + holders[b])) + 1 for b in range(langid.BUCKETS)}

    def vector(counts):
        return plain_unit({b: math.log1p(n) * idf[b] for b, n in counts.items()})

    by_lang = {}
    for r in taught:
        by_lang.setdefault(r["lang"], []).append(r["text"])
    centroids = {lang: plain_centroids([vector(plain_counts(t)[0]) for t in texts])
                 for lang, texts in sorted(by_lang.items())}

    def cosine(counts, lang):
        return max(plain_dot(vector(counts), c) for c in centroids[lang])

    @functools.cache
    def floor(lang, letters):
        texts = by_lang[lang]
        top = langid.REJECT_BELOW * np.percentile([cosine(plain_counts(t)[0], lang) for t in texts], 1)
        short = 0.0
        for size in [size for size in langid.BEGINNINGS if size <= letters]:
            heads = [h for h in (plain_beginning(t, size) for t in texts) if h is not None]
            found = [cosine(plain_counts(h)[0], lang) for h in heads if langid.has_letter(h)]
            short = max(short, langid.REJECT_SHORT * np.percentile(found, 5)) if found else top
        return min(top, short) if letters >= 2 else 0.0

    @functools.cache
    def least_run(lang):
        runs = [plain_counts(t)[1:] for t in by_lang[lang]]
        return langid.REJECT_RUNS * np.percentile([r for n, r in runs if n >= langid.LEAST_LETTERS], 1)

    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(found) == len(rows) and len(centroids) >= 4
    sure = 0
    for r in [r for r in rows if r["doc_id"] >= 9000 or r["doc_id"] % 4 == 0]:
        own = found[r["doc_id"]]
        if not langid.has_letter(r["text"]):
            assert (own["lang_pred"], own["score"], own["rejected"]) == ("und", 0.0, True)
            continue
        counts, letters, run = plain_counts(r["text"])
        cosines = sorted(((cosine(counts, lang), lang) for lang in centroids), reverse=True)
        best, lang = cosines[0]
        assert abs(own["score"] - best) < 0.002
        if best - cosines[1][0] > 0.004:
            sure += 1
            assert own["lang_pred"] == lang
            least, gap = least_run(lang), best - floor(lang, letters)
            if abs(gap) > 0.002 and abs(run - least) > 0.01:
                assert own["rejected"] == (gap < 0 or letters >= langid.LEAST_LETTERS and run < least)
    assert sure >= 40


def test_all_texts_set_centroids_and_floors(spark, monkeypatch):
    """With a sample of few texts the model is still that of all: odd texts outside it count."""
    rows = [(i, text, lang) for i, text, lang in learned(spark)]
    odd = [(5000 + i, f"{i % 7} zebra quilt vixen jumbo pyx", "en") for i in range(60)]
    docs = documents(spark, rows + odd)
    monkeypatch.setattr(langid, "CENTROIDS", 1)
    whole = langid.fit(docs)
    monkeypatch.setattr(langid, "SAMPLE", 5)
    few = langid.fit(docs)
    assert few.languages == whole.languages == ["de", "en"]
    assert np.abs(few.vectors - whole.vectors).max() < 1e-5
    assert np.abs(few.floors - whole.floors).max() < 1e-3 and np.abs(few.runs - whole.runs).max() < 1e-6
