"""Readers, writers and streams on small files."""

import io
import json
import os
import re
import wave

import numpy as np

from talkweave.sources import readers, sinks
from talkweave.streaming import sessions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_json_documents(spark, tmp_path):
    chunk = {"start": 1000, "end": 2000, "segments": [[1.0, 2.0]], "transcription": [{"text": "hej", "model": "m", "word_timestamps": [{"word": "hej", "start_time": 0.1, "end_time": 0.4}]}]}
    write(tmp_path / "d/a.json", json.dumps({"metadata": {"audio_path": "a.mp3", "dates": ["2000-01-02", "2000-01-01"]}, "chunks": [chunk, chunk | {"start": 5000, "end": 6000}]}))
    docs = readers.transcribed_documents(spark, str(tmp_path / "d"))
    flat = readers.flattened(docs).collect()
    assert [(r.pos, r.start, r.audio_path) for r in flat] == [(0, 1000, "a.mp3"), (1, 5000, "a.mp3")]
    r = readers.recording_transcripts(docs).first()
    assert r.inference_text == "hej hej" and [round(w.start_time, 3) for w in r.words] == [1.1, 5.1] and (r.date_start, r.date_end) == ("2000-01-01", "2000-01-02")
    entry = json.dumps({"anforande": {"dok_id": "x", "talare": ""}}, indent=1)
    write(tmp_path / "p/a.json", b"\xef\xbb\xbf" + entry.encode())
    got = readers.protocol_entries(spark, str(tmp_path / "p")).first()
    assert got.dok_id == "x" and got.talare is None


def test_protocols(spark, tmp_path):
    xml = """<TEI xmlns="http://x"><docDate when="2000-01-01"/><docDate when="2000-01-02"/><div><note type="speaker" xml:id="i1">A</note><u who="p1" next="u2">Herr <b>talman</b></u>
    <u who="p1">  mera </u><note type="speaker" xml:id="i2">B</note><u who="p2">Svar</u><u who="p3" next="u9">pending</u></div></TEI>"""
    write(tmp_path / "prot-1.xml", xml)
    write(tmp_path / "prot-2.xml", "<broken")
    rows = readers.protocols(spark, str(tmp_path)).where("speech_id IS NOT NULL").orderBy("pos").collect()
    assert [(r.speech_id, r.speaker_id, r.text) for r in rows] == [("i1", "p1", "Herr talman mera"), ("i2", "p2", "Svar")]
    numbered = readers.speech_rows(readers.protocols(spark, str(tmp_path))).collect()
    assert sorted((r.speech_number, str(r.date)) for r in numbered) == [(1, "2000-01-01"), (1, "2000-01-02"), (2, "2000-01-01"), (2, "2000-01-02")]


def test_segments_ctm_and_listing(spark, tmp_path):
    write(tmp_path / "s.jsonl", '{"file":"b","start":1.0,"end":2.0,"text":" x  y "}\n{"file":"a","start":3.0,"end":4.0,"text":""}\n')
    assert [(r.file, r.words) for r in readers.segments(spark, str(tmp_path / "s.jsonl")).collect()] == [("a", []), ("b", ["x", "y"])]
    write(tmp_path / "s.json", '[{"file":"b","start":1.0,"end":2.0,"text":"x"}]')
    assert readers.segments(spark, str(tmp_path / "s.json"), array=True).count() == 1
    write(tmp_path / "c.ctm", "u 1 0.10 0.25 hej\nu 1 0.5 0.5 du\n")
    assert [(r.start_ms, r.end_ms, r.word) for r in readers.ctm(spark, str(tmp_path / "c.ctm")).orderBy("start_ms").collect()] == [(100, 350, "hej"), (500, 1000, "du")]
    write(tmp_path / "w.scp", "u /a/b c.wav\n")
    assert readers.wav_scp(spark, str(tmp_path / "w.scp")).first().path == "/a/b c.wav"
    for year in (1964, 1970):
        write(tmp_path / f"l/{year}/x.mp3", "abc")
    files = readers.listing(spark, str(tmp_path / "l"), "*.mp3")
    assert files.count() == 2 and readers.in_years(files, 1965, 2003).count() == 1 and readers.listing(spark, str(tmp_path / "l"), "*.mp3", 10).count() == 0
    write(tmp_path / "persons.csv", "Id,Förnamn,Efternamn,Född,Kön,Valkrets,Parti,Uppdragsroll,From,Tom\n1,A,B,1950,man,x,S,r,2000-01-01,\n")
    assert readers.persons(spark, str(tmp_path / "persons.csv")).first().Parti == "S"


def test_binary_sources(spark, tmp_path):
    buffer = io.BytesIO()
    np.save(buffer, np.arange(6, dtype=np.float32).reshape(2, 3))
    write(tmp_path / "e/a.npy", buffer.getvalue())
    r = readers.emissions(spark, str(tmp_path / "e")).first()
    assert r["shape"] == [2, 3] and r["values"][5] == 5.0
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(16_000)
        w.writeframes(np.array([0, 16384], "<i2").tobytes())
    write(tmp_path / "a/good.wav", out.getvalue())
    write(tmp_path / "a/bad.wav", b"nothing")
    got = {os.path.basename(r.path): r for r in readers.wav_audio(spark, str(tmp_path / "a")).collect()}
    assert got["good.wav"].audio == [0.0, 0.5] and got["bad.wav"].error
    df = spark.createDataFrame([([0.0, 0.5],), (None,)], "x array<float>")
    made = [r.w for r in df.select(sinks.wav_bytes()("x").alias("w")).collect()]
    assert made[1] is None and wave.open(io.BytesIO(made[0])).getnframes() == 2


def test_fetching_retries(spark):
    def get(k):
        if k == "bad":
            raise OSError("no network")
        return k.upper()

    got = {r.k: (r.body, r.error) for r in readers.fetched(spark.createDataFrame([("a",), ("bad",)], "k string"), "k", get, backoff_s=0).collect()}
    assert got == {"a": ("A", None), "bad": (None, "OSError: no network")}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("0000", 1), ("0001", 2)], "shard string, v int")
    sinks.sharded(df, str(tmp_path / "s"))
    sinks.sharded(df.unionByName(spark.createDataFrame([("0002", 3)], df.schema)), str(tmp_path / "s"))
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "s")).collect()) == [1, 2, 3]
    speeches = spark.createDataFrame([("f", 5.0, 2.0, "b"), ("f", 1.0, 3.0, "a")], "audio_file string, start_segment double, duration_segment double, text string")
    doc = sinks.recording_documents(speeches, "old").first()
    assert doc.metadata.number_of_speeches == 2 and doc.metadata.duration == 5.0 and [s.text for s in doc.speeches] == ["a", "b"]
    sinks.json(sinks.recording_documents(speeches, "old"), str(tmp_path / "j"), by="audio_file")
    assert os.path.isdir(tmp_path / "j/audio_file=f")
    protocol = spark.createDataFrame([("p", 2, ["2000-01-02"]), ("p", 1, ["2000-01-01"])], "protocol_id string, speech_number int, dates array<string>")
    assert sinks.protocol_documents(protocol).first().metadata.dates == ["2000-01-01", "2000-01-02"]
    sinks.kaldi(spark.createDataFrame([("f.wav", 0.0, 1.5, "hej du")], "file string, start double, end double, text string"), str(tmp_path / "k"))
    assert spark.read.text(str(tmp_path / "k/segments")).first().value == "seg001-0001 reco001 0.00 1.50"
    sinks.vocabulary(spark.createDataFrame([("hej", 1), ("på dig", 2)], "word string, id long"), str(tmp_path / "v"))
    assert sorted(map(tuple, sinks.read_vocabulary(spark, str(tmp_path / "v")).collect())) == [("hej", 1), ("på dig", 2)]
    assert sinks.markdown(spark.createDataFrame([(1, 0.5)], "a int, b double")) == "| a | b |\n|---|---|\n| 1 | 0.50 |"


def test_stream_equals_batch(spark, tmp_path):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    rows = [(k, t0 + timedelta(minutes=m)) for k in (1, 2) for m in (0, 10, 100, 110, 500)] + [(9, t0 + timedelta(days=9))]
    batch = spark.createDataFrame(rows, "k int, ts timestamp")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = sessions.sessions(sessions.read_folder(spark, str(tmp_path / "in"), "k int, ts timestamp"), "k")
    sessions.resume(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r.k, r.start, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.k, r.start, r.n) for r in sessions.sessions(batch, "k").collect()}
    assert {x for x in want if x[0] != 9} <= got | {x for x in want if x[0] == 9} and got <= want
    assert len(want) == 7 and sessions.totals(batch.withColumn("v", batch.k), "k", "v").count() == 3


def test_nothing_else_imports_llm():
    for folder, _, names in os.walk(os.path.join(ROOT, "talkweave")):
        if "llm" not in folder.split(os.sep):
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n), encoding="utf-8") as f:
                        assert not re.search(r"import.*\bllm\b|from.*\bllm\b", f.read()), n
