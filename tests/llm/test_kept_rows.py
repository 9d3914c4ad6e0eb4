from corpusloom.llm import languages

from . import cases


def test_each_row_goes_by_its_own_text(spark):
    """Rejected rows without doc_id go; a clean row stays where a rejected one has its doc_id."""
    docs = cases.table(spark)
    clean = languages.keep_identified(docs).where("doc_id is not null").orderBy("doc_id").first()
    twin = [clean, (clean["doc_id"], "", *clean[2:]), (None, "123 456", *clean[2:]), (None, *clean[1:])]
    every = docs.unionByName(spark.createDataFrame(twin[1:], cases.SCHEMA))
    kept = languages.keep_identified(every)
    judged = languages.identify(every, languages.train(every)).where("lang_pred <> 'und' and not ambiguous")
    assert kept.count() == judged.count() < every.count()
    rows = [tuple(r) for r in kept.collect()]
    assert tuple(clean) in rows and tuple(twin[3]) in rows
    assert not any(r[1] in (None, "", "123 456") for r in rows)
