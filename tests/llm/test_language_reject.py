"""Texts in languages that were not learned, short and long, beside texts that were."""

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language_id
from tests.conftest import SF_CHECK
from tests.llm.helpers import docs

FOREIGN = [
    "La mattina presto i pescatori tornano al porto con le reti piene e il mercato si riempie di voci e di colori mentre i bambini corrono verso la scuola lungo le strade strette della città vecchia",
    "De manhã cedo os pescadores voltam ao porto com as redes cheias e o mercado enche-se de vozes e de cores enquanto as crianças correm para a escola pelas ruas estreitas da cidade velha",
    "Vroeg in de ochtend keren de vissers terug naar de haven met volle netten en de markt vult zich met stemmen en kleuren terwijl de kinderen door de smalle straten van de oude stad naar school rennen",
    "Tidigt på morgonen återvänder fiskarna till hamnen med fulla nät och torget fylls av röster och färger medan barnen springer till skolan genom de smala gatorna i den gamla staden",
    "Wczesnym rankiem rybacy wracają do portu z pełnymi sieciami a targ wypełnia się głosami i kolorami podczas gdy dzieci biegną do szkoły wąskimi uliczkami starego miasta",
    "Varhain aamulla kalastajat palaavat satamaan verkot täynnä ja tori täyttyy äänistä ja väreistä kun lapset juoksevat kouluun vanhan kaupungin kapeita katuja pitkin",
    "Sabah erkenden balıkçılar dolu ağlarla limana dönüyor ve çocuklar eski şehrin dar sokaklarından okula koşarken pazar sesler ve renklerle doluyor",
]


def test_unlearned_languages_are_rejected(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(table, ~held)
    short = [(i, " ".join(t.split()[:12])) for i, t in enumerate(FOREIGN)]
    long = [(100 + i, t) for i, t in enumerate(FOREIGN)]
    got = language_id.classify(docs(spark, short + long), model).collect()
    kept = [r for r in got if not r.rejected]
    assert not kept, kept
    known = language_id.classify(table.filter(held), model).collect()
    far = [r for r in known if r.rejected and r.score > 0]
    assert len(known) > 2000 and len(far) <= 0.003 * len(known), [(r.doc_id, r.score) for r in far]


def test_one_odd_row_sets_no_limit():
    rnd = np.random.default_rng(1)
    top, best, size = rnd.uniform(0.6, 0.9, 4000), rnd.integers(0, 4, 4000), rnd.integers(8, 11, 4000)
    plain = language_id.limits(best, size, top, top > 0, 4)
    assert (plain[8:] > 0.35).all() and (plain[:8] == 0).all()
    odd = np.where(np.arange(4000) == 7, 0.01, top)
    assert (language_id.limits(best, size, odd, top > 0, 4)[8:] > 0.35).all()


def test_beginnings_have_short_lengths(spark):
    model = language_id.train(spark.read.parquet(f"{SF_CHECK}/documents.parquet"), F.lit(True))
    assert (model["least"][5:11] > 0).all()
