"""Golden rows of names and addresses."""

import pytest
from pyspark.sql import functions as F

from korvane.functions import text

NAMES = [
    ("Granite Harbour Holdings LLC", "granite harbour holdings llc", "granite harbour holdings", "llc", "", "ghh"),
    ("Pvt. Quill Paper Mills Ltd.", "pvt. quill paper mills ltd.", "pvt. quill paper mills", "limited", "", "qpm"),
    ("MEERA TEXTILES EXPORTS CORPORATION | www.meera.com", "meera textiles exports corporation", "meera textiles exports corporation", "", "", "mtec"),
    ("Acme Pvt. Ltd.", "acme pvt. ltd.", "acme", "private limited", "", "a"),
    ("Acme P.L.C.", "acme p.l.c.", "acme p.l.c.", "", "", "a"),
    ("Co Ltd", "co ltd", "", "company limited", "", ""),
    ("A & B + C", "a and b and c", "a and b and c", "", "", "aa"),
    ("Acme dba Best | Z", "acme", "acme", "", "Best | Z", "a"),
    ("dba Best", "dba best", "dba best", "", "Best", "db"),
    ("Foo a.k.a. Bar", "foo a.k.a. bar", "foo a.k.a. bar", "", "", "fb"),
    ("Café Étoile SARL", "cafe etoile sarl", "cafe etoile", "sarl", "", "ce"),
    ("", "", "", "", "", ""),
    (None, "", "", "", "", ""),
]
ADDRESSES = [
    ("248 Larkspur Dr, Cedar Ridge, TX", "248 larkspur drive cedar ridge, tx", ["248"], "", "", None),
    ("63, Palm Grove Block C, Mysuru, Hassan, Karnataka", "63, palm grove block c, mysuru, hassan, karnataka", ["63"], "", "", None),
    ("All Saints Rd., Apt 5", "allee saints road appartement 5", ["5"], "", "", None),
    ("P.O. Box 9", "p.o. box 9", ["9"], "", "", None),
    ("Shop 4 near City Mall Main Rd Delhi", "shop 4 near city mall main road delhi", ["4"], "", "City Mall Main Rd", "shop 4 delhi"),
    ("12/3-4 Main 5b 77", "12/3-4 main 5b 77", ["12/3-4", "77"], "", "", None),
    ("Paris 75001-1234", "paris 75001-1234", ["75001-1234"], "75001", "", None),
    ("75001 x 110001", "75001 x 110001", ["75001", "110001"], "110001", "", None),
    (None, "", [], "", "", None),
]


def test_names(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(NAMES)], "i int, name string").select("i", text.name_parts(F.col("name")).alias("p"))
    got = {r.i: (r.p.cleaned, r.p.name_only, r.p.legal_suffix, r.p.dba_name, r.p.acronym) for r in df.collect()}
    assert [got[i] for i in range(len(NAMES))] == [r[1:] for r in NAMES]


def test_addresses(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(ADDRESSES)], "i int, a string").select("i", text.address_parts(F.col("a")).alias("p"))
    got = {r.i: (r.p.cleaned, r.p.numbers, r.p.pin_zip, r.p.landmarks, r.p.no_landmarks) for r in df.collect()}
    assert [got[i] for i in range(len(ADDRESSES))] == [(c, n, z, m, c if w is None else w) for _, c, n, z, m, w in ADDRESSES]


@pytest.mark.parametrize(("token", "want"), [("Ltd.", "limited"), ("Works", "works")])
def test_canonical_suffix(spark, token, want):
    assert spark.range(1).select(text.canonical_suffix(F.lit(token))).first()[0] == want
