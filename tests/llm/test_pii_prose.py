from epiloom.llm import pii


def test_prose_contexts_and_long_values(spark):
    rows = [(i, f"You can call me at +1 (555) 010-10{i} today. Just write to user{i}@mail.example.com now.") for i in range(10, 24)]
    rows += [(100, "You can call me at 55x0199 today."), (101, "Please write to someone@intranet, thanks"), (102, "there are 12345 cars at 17:30"), (103, "so write to " + "z" * 90 + "@x ok")]
    rows += [(200 + i, f"contact: user{i}@mail.example.com") for i in range(8)] + [(300, "contact: " + "k" * 100 + "77 end")]
    rows += [(400 + i, f"they met at {i}:30 again") for i in range(30)]  # "at" alone is no phone context
    got = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.spans] for r in pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == [("context_phone", "55x0199")] and got[101] == [("context_email", "someone@intranet")]
    assert got[102] == [] and got[103] == [("context_email", "z" * 90 + "@x")]
    assert got[300] == [("context_email", "k" * 100 + "77")]
    assert [k for k, _ in got[12]] == ["phone", "email"]
