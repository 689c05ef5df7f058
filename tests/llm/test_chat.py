"""Chat formatting: exact round trips, placeholders and masks."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketloom.llm import chat

texts = st.text(alphabet="<|\\>\n aé😀im_start_end", max_size=40) | st.sampled_from([chat.START, chat.END, "<\\|im_end|>", "<|image|>", "<"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "to\nol", "a\\n"]), st.lists(texts, min_size=0, max_size=3)), max_size=5))
def test_round_trip(turns):
    made = chat.format_turns([{"role": r, "parts": [{"type": "text", "text": t} for t in ts]} for r, ts in turns])
    assert chat.parse(made["formatted"]) == [(r, "".join(ts)) for r, ts in turns]
    said = [chat.unescape(made["formatted"][m["start"] : m["end"]]) for m in made["loss"]]
    assert said == ["".join(ts) for r, ts in turns if r == "assistant"]


def test_parts_become_ordered_placeholders():
    parts = [{"type": "text", "text": "see <"}, {"type": "text", "text": "|image|>"}, {"type": "image", "ref": "a.png", "width": 28, "height": 15}, {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "text", "text": "end"}, {"type": "document", "ref": "c.pdf", "pages": 3}, None]
    made = chat.format_turns([{"role": "user", "parts": parts}])
    assert made["formatted"] == "<|im_start|>user\nsee <\\|image|><|image|><|audio|>end<|document|><|im_end|>\n"
    assert [(a["position"], a["type"], a["ref"], a["tokens"]) for a in made["attachments"]] == [(0, "image", "a.png", 4), (1, "audio", "b.wav", 38), (2, "document", "c.pdf", 768)]


def test_table_with_nulls_ties_and_clashes(spark):
    src = spark.createDataFrame([(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, 1, "assistant", "b", 0), (None, 0, None, None, 0), (2, None, "user", "x" * 100_000, 0)], "conv_id long, turn long, role string, text string, turns int")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_chats(src.withColumn("parts", chat.text_part(F.col("text"))))).collect()}
    assert out[1]["n_turns"] == 3 and out[1]["loss_chars"] == 2 and out[None]["n_turns"] == 1 and out[2]["formatted_chars"] > 100_000
    empty = src.where("false").withColumn("parts", chat.text_part(F.col("text")))
    assert chat.digests(chat.format_chats(empty)).count() == 0
