"""Nested dumps: splits, posts without content, escapes, what can't be read."""

from threadloom.sources import nested

DUMP = """<?xml version="1.0" encoding="utf-8"?>
<root>
<post Id="7" Score="3" Title="a &gt; b &amp; &quot;c&quot; /&gt; é" Tags="&lt;b&gt;&lt;a&gt;">
  <comments><comment Id="2" Text="second"/><comment Id="1" Text="&#10;x"/></comments>
  <answers>
    <answer Id="10" Score="1" Body="low"><comments><comment Id="5" Score="x" Text="c"/></comments></answer>
    <answer Id="11" Score="9" Body="high"/><answer Id="12" Score="9" Body="tie"><comments/></answer><answer Score="" Body="none"/>
  </answers>
  <links><link Id="1" LinkTypeId="1" Name="l"/><link Id="2" LinkTypeId="3" Name="d"/><link Id="3" LinkTypeId="9"/></links>
</post>
<post Id="8" Title='single > "quotes"' Tags="|x|y|"/><post Id="9" DeletionDate="2020"><links/></post>
<post Id="" Score="many"><answers/></post>
<post Id="13" Broken="1><answers></post>
<post Id="14"
  Title="two lines"></post>
<post/>
</root>
"""


def test_questions(spark, tmp_path):
    (tmp_path / "posts.xml").write_text(DUMP)
    for size in ["128m", "60"]:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            good, bad = nested.questions(spark, f"file://{tmp_path}/posts.xml")
            rows, lost = good.collect(), bad.collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(lost) == 1 and "Broken" in lost[0]._corrupt_record
        assert sorted(r.Id for r in rows) == [0, 0, 7, 8, 9, 14]
        q = {r.Id: r for r in rows}
        seven = q[7]
        assert (seven.Title, seven.Tags, seven.Score, seven.nb_answers, seven.deleted) == ('a > b & "c" /> é', ["a", "b"], 3, 4, False)
        assert [(a.Id, a.Score, a.Body, len(a.comments)) for a in seven.answers] == [(11, 9, "high", 0), (12, 9, "tie", 0), (10, 1, "low", 1), (0, 0, "none", 0)]
        assert [(c.Id, c.Text) for c in seven.comments] == [(2, "second"), (1, "\nx")] and seven.answers[2].comments[0].Score == 0
        assert [(x.Id, x.Name) for x in seven.links.linked] == [(1, "l")] and [(x.Id, x.Name) for x in seven.links.duplicate] == [(2, "d")]
        assert (q[8].Title, q[8].Tags, q[8].answers, q[8].comments) == ('single > "quotes"', ["x", "y"], [], [])
        assert q[9].deleted and not q[14].deleted and q[14].Title == "two lines"
