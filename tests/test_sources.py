from types import SimpleNamespace

import pytest

from registra import schemas
from registra.plans import ontology, triples
from registra.sources import rdf, shared, sinks, tables


def test_csv_is_typed_and_strict(spark, tmp_path):
    good = tmp_path / "departments.csv"
    good.write_text('id,name\n1,"Большие данные (Spark, Hadoop)"\n2,\n')
    assert [tuple(r) for r in tables.read_departments(spark, str(good)).collect()] == [
        (1, "Большие данные (Spark, Hadoop)"),
        (2, None),
    ]
    bad = tmp_path / "bad.csv"
    bad.write_text("id,name\n1,a\nx,b\n")
    with pytest.raises(Exception):
        tables.read_departments(spark, str(bad)).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    file = tmp_path / "departments.csv"
    file.write_text('id,name\n1,"one\ntwo"\n')
    read = tables.load_csv(spark.read, str(file), schemas.DEPARTMENTS, multi_line=True)
    assert [tuple(r) for r in read.collect()] == [(1, "one\ntwo")]


def test_skill_tables(spark, tmp_path):
    for name, schema in schemas.SKILL_TABLES.items():
        cells = ["1" if f.dataType == schemas.INT else "слово, слово" for f in schema.fields]
        line = ",".join(f'"{c}"' if "," in c else c for c in cells)
        (tmp_path / f"{name}.csv").write_text(",".join(schema.fieldNames()) + "\n" + line + "\n")
    read = tables.read_skill_tables(spark, str(tmp_path))
    assert read["employees"].first() == (1, "слово, слово", 1)
    assert all(df.count() == 1 for df in read.values())


def test_written_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "a", b'), (2, None), (3, "")], schemas.DEPARTMENTS)
    sinks.write_csv(df, str(tmp_path / "out"))
    read = tables.read_csv_table(spark, str(tmp_path / "out"), schemas.DEPARTMENTS)
    assert sorted(map(tuple, read.collect())) == [(1, 'say "a", b'), (2, None), (3, "")]


def test_reader_for_any_format(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.read_table(spark, "parquet", path).count() == 3
    with pytest.raises(ValueError, match="upperBound"):
        tables.read_table(spark, "jdbc", url="x", partitionColumn="id", lowerBound=0, numPartitions=4)


def test_counts_and_listing(spark):
    spark.range(4).createOrReplaceTempView("four_rows")
    assert "four_rows" in tables.list_tables(spark)
    assert [tuple(r) for r in tables.row_counts({"four": spark.table("four_rows")}).collect()] == [("four", 4)]


def test_work_folder_follows_the_setting(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared.work_folder(spark)
    assert folder.startswith(setting) if setting else folder == spark.sparkContext.getCheckpointDir()
    empty = shared.written(spark.range(0), "empty")
    assert empty.count() == 0 and empty.columns == ["id"]


def test_cluster_without_shared_folder_is_refused():
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.work_folder(cluster)


OWL = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:owl="http://www.w3.org/2002/07/owl#"
         xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns="http://example.org/t#">
<owl:ObjectProperty rdf:about="#имеет"><rdfs:domain rdf:resource="#Клиент"/><rdfs:range rdf:resource="#Счет"/></owl:ObjectProperty>
<owl:ObjectProperty rdf:about="#владеет"><rdfs:domain rdf:resource="#Клиент"/><rdfs:range rdf:resource="#Счет"/></owl:ObjectProperty>
<owl:ObjectProperty rdf:about="#ведёт"><rdfs:domain rdf:resource="#Клиент"/><rdfs:range rdf:resource="#Банк"/></owl:ObjectProperty>
<owl:Class rdf:about="#Клиент"/><owl:Class rdf:about="#Счет"/><owl:Class rdf:about="#Кредит"/>
<owl:NamedIndividual rdf:about="#к_1">
  <rdf:type rdf:resource="#Клиент"/>
  <имеет rdf:resource="#с_1"/>
  <имеет rdf:resource="#с_2"/>
  <фио rdf:datatype="http://www.w3.org/2001/XMLSchema#string">А &amp; Б</фио>
</owl:NamedIndividual>
<owl:NamedIndividual rdf:about="#с_1"><rdf:type rdf:resource="#Счет"/></owl:NamedIndividual>
</rdf:RDF>
"""
IRI = "http://example.org/t#"


@pytest.fixture
def owl(tmp_path):
    path = tmp_path / "t.owl"
    path.write_text(OWL)
    return str(path)


def test_read_individuals(spark, owl):
    facts = rdf.read_rdf_xml(spark, owl, IRI, ["имеет"], ["фио"])
    assert {(r.subject, r.predicate, r.object, r.object_kind) for r in facts.collect()} == {
        (IRI + "к_1", triples.TYPE, IRI + "Клиент", "iri"),
        (IRI + "к_1", IRI + "имеет", IRI + "с_1", "iri"),
        (IRI + "к_1", IRI + "имеет", IRI + "с_2", "iri"),
        (IRI + "к_1", IRI + "фио", "А & Б", "literal"),
        (IRI + "с_1", triples.TYPE, IRI + "Счет", "iri"),
    }


def test_xml_round_trip(spark, owl, tmp_path):
    facts = rdf.read_rdf_xml(spark, owl, IRI, ["имеет"], ["фио"])
    path = str(tmp_path / "copy")
    rdf.write_rdf_xml(facts, path, IRI, ["имеет"], ["фио"])
    copy = rdf.read_rdf_xml(spark, path, IRI, ["имеет"], ["фио"])
    assert sorted(copy.collect()) == sorted(facts.collect())


def test_class_graph(spark, owl):
    nodes, edges = triples.class_graph(*rdf.read_class_schema(spark, owl, IRI))
    assert {r[0].removeprefix(IRI) for r in nodes.collect()} == {"Клиент", "Счет", "Кредит", "Банк"}
    found = {tuple(v.removeprefix(IRI) for v in (r.source, r.target, r.label)) for r in edges.collect()}
    # of two properties between the same classes the one declared last gives the label
    assert found == {("Клиент", "Счет", "владеет"), ("Клиент", "Банк", "ведёт")}


def test_ntriples_escapes(spark):
    facts = spark.createDataFrame(
        [("s", "p", 'a "b"\\\nc', "literal", "t"), ("s", "p", "o", "iri", None)],
        "subject string, predicate string, object string, object_kind string, datatype string",
    )
    assert [r.value for r in rdf.ntriples_lines(facts).collect()] == [
        '<s> <p> "a \\"b\\"\\\\\\nc"^^<t> .',
        "<s> <p> <o> .",
    ]


def test_blanks_and_line_breaks_survive_csv(spark, tmp_path):
    rows = [(1, "  a  "), (2, " "), (3, "two\nlines, \"quoted\" "), (4, None), (5, "")]
    sinks.write_csv(spark.createDataFrame(rows, schemas.DEPARTMENTS), str(tmp_path / "out"))
    read = tables.read_csv_table(spark, str(tmp_path / "out"), schemas.DEPARTMENTS, multi_line=True)
    assert sorted(map(tuple, read.collect())) == rows


def test_unlisted_predicates_are_refused(spark, owl, tmp_path):
    facts = rdf.read_rdf_xml(spark, owl, IRI, ["имеет"], ["фио"])
    for links, values in ((["имеет"], []), ([], ["фио"]), (["фио"], ["имеет"])):
        with pytest.raises(Exception, match="no place for the predicate"):
            rdf.write_rdf_xml(facts, str(tmp_path / "refused"), IRI, links, values)
    with pytest.raises(ValueError, match="no place for the element фио"):
        rdf.read_rdf_xml(spark, owl, IRI, ["имеет"], [])


def test_lines_hold_no_invalid_names(spark):
    facts = spark.createDataFrame([("s A>", "p", "o\tB", "iri", None)], "subject string, predicate string, object string, object_kind string, datatype string")
    assert [r.value for r in rdf.ntriples_lines(facts).collect()] == ["<s%20A%3E> <p> <o%09B> ."]


def test_declarations_come_back_from_their_file(spark, tmp_path):
    for declared in (ontology.SKILLS, ontology.BANK):
        path = str(tmp_path / declared.classes[0])
        ontology.write_schema(spark, declared, path)
        classes, domains, ranges = rdf.read_class_schema(spark, f"{path}/*", declared.iri)
        assert {r[0] for r in classes.collect()} == {declared.iri + c for c in declared.classes}
        assert {(r["property"], r["class"]) for r in domains.collect()} == {(declared.iri + p, declared.iri + d) for p, d, _ in declared.links}
        assert {(r["property"], r["class"]) for r in ranges.collect()} == {(declared.iri + p, declared.iri + t) for p, _, t in declared.links}
        order = [r["property"] for r in domains.orderBy("declared").collect()]
        assert order == [declared.iri + p for p, _, _ in declared.links]
        facts = ontology.schema_triples(spark, declared)
        assert facts.count() == len(declared.classes) + 3 * (len(declared.links) + len(declared.values))


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    people = "\n".join(
        f'<owl:NamedIndividual rdf:about="#к_{i}">\n<!-- <x> --><rdf:type rdf:resource="#Клиент"/><имеет\nrdf:resource="#с_{i}"/><фио>человек {i}</фио></owl:NamedIndividual>'
        if i % 2
        else f'<rdf:Description rdf:about="#к_{i}"><имеет rdf:resource="http://other/{i}"></имеет></rdf:Description>\n<owl:Class rdf:about="#Класс_{i}"/>'
        for i in range(1000)
    )
    path = str(tmp_path / "large.owl")
    (tmp_path / "large.owl").write_text(OWL.replace("<owl:NamedIndividual", people + "\n<owl:NamedIndividual", 1))
    setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        wanted = None
        for size in (setting, "9001", "20000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = sorted(rdf.read_rdf_xml(spark, path, IRI, ["имеет"], ["фио"]).collect(), key=str)
            assert len(found) == 5 + 3 * 500 + 500 and wanted in (None, found)
            wanted = found
        assert rdf._elements(spark, path, ("rdf:Description",), ["имеет", "фио"]).rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", setting)
    assert (IRI + "к_4", IRI + "имеет", "http://other/4", "iri", None) in [tuple(r) for r in wanted]


@pytest.mark.parametrize("broken", ['<имеет><x:Счет rdf:about="#с_9"/></имеет>', '<фио>said rdf:about="x</фио>'])
def test_what_cannot_be_cut_is_refused(spark, tmp_path, broken):
    path = tmp_path / "t.owl"
    path.write_text(OWL.replace("<имеет", broken + "<имеет", 1))
    with pytest.raises(ValueError, match="an individual inside another"):
        rdf.read_rdf_xml(spark, str(path), IRI, ["имеет"], ["фио"])


def test_unknown_element_at_the_end_of_a_line(spark, tmp_path):
    path = tmp_path / "t.owl"
    path.write_text(OWL.replace("<фио ", "<имя\n", 1).replace("</фио>", "</имя>"))
    with pytest.raises(ValueError, match="no place for the element имя"):
        rdf.read_rdf_xml(spark, str(path), IRI, ["имеет"], ["фио"])


def test_texts_of_any_form(spark, tmp_path):
    path = tmp_path / "t.owl"
    more = "<фио/><фио></фио><фио>  two\n lines </фио><фио rdf:datatype='d' >&lt;&quot;&amp;lt;&gt;</фио><rdfs:label>x</rdfs:label><имеет  rdf:resource = '#с_&amp;'></имеет>"
    other = '<owl:NamedIndividual rdf:about="#к_2" x="1"><фио>&#1040; <![CDATA[<b>]]></фио><имеет rdf:resource="#с_3"/></owl:NamedIndividual>'
    path.write_text(OWL.replace("<имеет", more + "<имеет", 1).replace("</rdf:RDF>", other + "</rdf:RDF>"))
    found = [(r.subject, r.object, r.datatype) for r in rdf.read_rdf_xml(spark, str(path), IRI, ["имеет"], ["фио"]).collect()]
    texts = [(o, d) for s, o, d in found if s == IRI + "к_1" and not str(o).startswith(IRI)]
    assert sorted(texts, key=str) == sorted([(None, None), (None, None), ("two\n lines", None), ('<"&lt;>', "d"), ("А & Б", triples.XSD + "string")], key=str)
    assert (IRI + "к_1", IRI + "с_&", None) in found
    assert sorted(o for s, o, _ in found if s == IRI + "к_2") == sorted([IRI + "с_3", "А <b>"])


def test_individuals_round_trip_with_relative_names(spark, owl, tmp_path):
    facts = rdf.read_rdf_xml(spark, owl, IRI, ["имеет"], ["фио"])
    path = str(tmp_path / "copy")
    rdf.write_rdf_xml(facts, path, IRI, ["имеет"], ["фио"], row_tag="owl:NamedIndividual", relative=True)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert 'owl:NamedIndividual rdf:about="#к_1"' in text and 'rdf:resource="#с_2"' in text
    assert sorted(rdf.read_rdf_xml(spark, path, IRI, ["имеет"], ["фио"]).collect()) == sorted(facts.collect())


def test_ntriples_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rdf, "_LINES_A_FILE", 1000)
    facts = spark.range(3000).coalesce(1).selectExpr(
        "concat('http://s/', id) AS subject", "'http://p' AS predicate", "concat('o ', id) AS object", "'literal' AS object_kind", "'http://d' AS datatype"
    )
    path = tmp_path / "lines"
    rdf.write_ntriples(facts, str(path))
    parts = list(path.glob("part-*"))
    found = sorted(r.value for r in spark.read.text(str(path)).collect())
    assert len(parts) == 3 and found == sorted(r.value for r in rdf.ntriples_lines(facts).collect())
    assert sum(p.stat().st_size for p in parts) * 4 < sum(len(line) + 1 for line in found)


def test_patterns_are_not_evaluated_twice(spark, owl):
    rows = rdf._elements(spark, owl, ("owl:NamedIndividual",), ["имеет", "фио"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("^(.*?)</") == 1 and not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line]


def test_single_elements_are_read_like_others(spark, tmp_path):
    elements = ['<фио>  a b\n</фио>', '<фио rdf:datatype="d">x</фио>', '<фио/>', '<имеет rdf:resource="#с_1"/>', '<имеет rdf:resource="http://o/1" ></имеет >',
                '<фио>&lt;1&amp;</фио>', '<фио x="1" rdf:datatype=\'e\'>y</фио>', '<rdfs:label>z</rdfs:label>', '<rdf:type rdf:resource="#К"/>']
    one = "".join(f'<owl:NamedIndividual rdf:about="#к_{i}">{e}</owl:NamedIndividual>\n' for i, e in enumerate(elements))
    # A comment takes a piece off the short way.
    two = "".join(f'<owl:NamedIndividual rdf:about="#к_{i}"><!-- -->{e}</owl:NamedIndividual>\n' for i, e in enumerate(elements))
    found = []
    for name, text in (("one", one), ("two", two)):
        path = tmp_path / f"{name}.owl"
        path.write_text(f'<rdf:RDF xmlns:rdf="{rdf.RDF_NS}">\n{text}</rdf:RDF>\n')
        rows = rdf.read_rdf_xml(spark, str(path), IRI, ["имеет"], ["фио"]).collect()
        found.append(sorted(map(tuple, rows), key=str))
    assert found[0] == found[1] and len(found[0]) == 8
    assert (IRI + "к_0", IRI + "фио", "a b", "literal", None) in found[0] and (IRI + "к_1", IRI + "фио", "x", "literal", "d") in found[0]
    path.write_text(f'<rdf:RDF xmlns:rdf="{rdf.RDF_NS}">\n{one.replace("фио", "имя")}</rdf:RDF>\n')
    with pytest.raises(ValueError, match="no place for the element имя"):
        rdf.read_rdf_xml(spark, str(path), IRI, ["имеет"], ["фио"])
