from __future__ import annotations

import zlib

from helpers import ODD, SMALL, odd, table
from millrace.llm.language import Classifier, dictionaries, identified
from millrace.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r[0]: r[2] for r in table("documents", folder)}
    rows = QUERIES["op10_language_id"](spark, folder).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["lang_pred"] in {*langs.values(), "und"} and 0 <= r["score"] <= 1
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in unseen) >= 0.97 * len(unseen)


def test_odd_rows(spark):
    labelled = odd(spark).filter("doc_id <= 9").select("text", "lang")
    contents = dictionaries(labelled)
    assert list(contents)[0] == "en" and None not in contents
    rows = identified(odd(spark), contents).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["doc_id"] in (1, 2, 3):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in contents
    assert dictionaries(labelled.limit(0)) == {}
    assert identified(odd(spark, []), contents).count() == 0


def test_ties_and_narrow_margins():
    same = Classifier({"b": b"words of a text", "a": b"words of a text"})
    assert same.classify("words of a text") == ("b", 0.0, True)
    assert Classifier({"a": b"x"}).classify("letters")[:2] == ("a", 1.0)
    assert Classifier({}).classify("letters") == ("und", 0.0, True)
    assert Classifier({"a": b"x"}).classify("123 !?")[0] == "und"
