"""Declared schemas of all inputs. Times are seconds as DOUBLE (_s) or milliseconds as BIGINT (_ms)."""

from __future__ import annotations

WORD = "STRUCT<word: STRING, start_time: DOUBLE, end_time: DOUBLE>"
TRANSCRIPTION = f"STRUCT<text: STRING, model: STRING, word_timestamps: ARRAY<{WORD}>>"
VAD_METADATA = "STRUCT<vad_model: STRING, vad_onset: DOUBLE, vad_offset: DOUBLE, vad_min_duration_on: DOUBLE, vad_min_duration_off: DOUBLE, audio_path: STRING, dates: ARRAY<STRING>, dok_id: STRING>"
VAD = f"metadata {VAD_METADATA}, chunks ARRAY<STRUCT<start: BIGINT, `end`: BIGINT, segments: ARRAY<ARRAY<DOUBLE>>, start_hhmmss: STRING, end_hhmmss: STRING>>"
TRANSCRIBED = (
    f"metadata {VAD_METADATA}, chunks ARRAY<STRUCT<start: BIGINT, `end`: BIGINT, segments: ARRAY<ARRAY<DOUBLE>>, start_hhmmss: STRING, end_hhmmss: STRING,"
    f" transcription: ARRAY<{TRANSCRIPTION}>, language_probs: MAP<STRING, MAP<STRING, DOUBLE>>>>"
)
DIARIZATION = (
    "metadata STRUCT<segmentation_model: STRING, clustering_model: STRING, embedding_model: STRING, audio_path: STRING>,"
    " chunks ARRAY<STRUCT<start: DOUBLE, `end`: DOUBLE, segment_id: STRING, speaker_id: STRING, start_hhmmss: STRING, end_hhmmss: STRING>>"
)
PROTOCOL_ENTRY = "anforande STRUCT<dok_id: STRING, anforande_nummer: STRING, rel_dok_id: STRING, avsnittsrubrik: STRING, anforandetext: STRING, talare: STRING, intressent_id: STRING>"
PERSONS = "Id STRING, `Förnamn` STRING, Efternamn STRING, `Född` STRING, `Kön` STRING, Valkrets STRING, Parti STRING, Uppdragsroll STRING, `From` TIMESTAMP, Tom TIMESTAMP"
SEGMENT = "file STRING, start DOUBLE, `end` DOUBLE, text STRING"
SPEECH = "text STRING, speaker_id STRING, speech_id STRING, protocol_id STRING, date ARRAY<STRING>, pos INT"
WEB_SPEECH = (
    "dok_id STRING, parti STRING, debatt_titel STRING, anf_text STRING, debatt_namn STRING, anf_datum STRING, url STRING, debateurl STRING, debatt_id STRING,"
    " audiofileurl STRING, downloadurl STRING, debatt_typ STRING, anf_nummer STRING, anf_nummer2 STRING, intressent_id STRING, intressent_id2 STRING, anf_id STRING,"
    " startpos STRING, anf_sekunder STRING, rel_dok_id STRING"
)
SUB = "start BIGINT, `end` BIGINT, duration BIGINT, text STRING, duplicate BOOLEAN, live BOOLEAN, is_long BOOLEAN, speech_id STRING, id INT"
