"""Schemas of the tables of a run."""

CANDIDATE = "id string, candidate_index int, candidate string, audio string, text string, source_json string, num_segments int"
GROUP = "record_index long, id string, text string, candidate_count int, candidates array<struct<candidate_index int, candidate string, audio string>>"
ERROR = "id string, source_json string, error string"
LABEL = CANDIDATE + ", asr_text string, language string, error string, asr_extra string, seq long"
RESULT = "id string, text string, best_candidate int, detail array<struct<candidate int, wer double, transcript string, audio string, error string>>"
