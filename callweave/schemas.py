"""Declared schemas; every reader states one, so no file is scanned to infer it."""

UNIVERSE = (
    "company_name string, ticker string, exchange string, country string, cik_or_sedar_id string, sec_cik string, "
    "sedar_status string, ir_page_url string, market_cap_bucket string, expected_call_language string"
)
MANIFEST = (
    "event_id long, ticker string, fiscal_period string, audio_path string, capture_mode string, started_at string, "
    "ended_at string, duration_sec double, sample_rate int, file_size long, sha256 string, failure_reason string, "
    "source_url string, replay_expiry_date string, url_located_by string"
)
WEBCAST_STATUS = (
    "ticker string, webcast_url string, url_source string, status string, http_status int, screenshot_path string, checked_at timestamp"
)
CALL_DATES = "ticker string, fiscal_period string, call_datetime_utc string, source_type string, source_url string"
REFERENCE_SOURCES = "ticker string, fiscal_period string, transcript_url string, publisher string"
CRAWL_LOG = (
    "id long, source string, target_url string, timestamp timestamp, http_status int, outcome string, duration_ms int, "
    "error_message string, correlation_id string"
)
EVENT_REGISTRY = (
    "id long, company_id long, ticker string, fiscal_period string, call_datetime_utc timestamp, timezone_as_published string, "
    "webcast_url string, dial_in_available boolean, replay_url string, replay_expiry_date timestamp, registration_required boolean, "
    "vendor string, discovery_source string, announced_at_utc timestamp, lead_time_hours double, discovered_at timestamp, confidence double"
)
SEGMENT = (
    "struct<start:double,end:double,speaker_id:string,speaker_name:string,speaker_role:string,text:string,confidence:double>"
)
TRANSCRIPT = (
    "event_id string, ticker string, fiscal_period string, call_datetime_utc string, language string, "
    f"sections array<struct<type:string,start:double,end:double,segments:array<{SEGMENT}>>>, segments array<{SEGMENT}>, "
    "pipeline struct<asr_model:string,diarizer:string,device:string,version:string>, _corrupt_record string"
)
CHUNK = "struct<chunk_idx:int,start_sec:double,end_sec:double,duration_sec:double,proc_time_sec:double,rtf:double>"
DROPPED = "struct<text:string,start:double,end:double,rule:string,avg_logprob:double,no_speech_prob:double>"
CALL_METRICS = (
    "ticker string, fiscal_period string, call_datetime_utc string, audio_path string, audio_duration_sec double, "
    "asr_infer_time_sec double, asr_rtf double, diarization_time_sec double, diarization_rtf double, resolution_time_sec double, "
    "total_pipeline_time_sec double, total_rtf double, queue_drained boolean, post_call_latency_sec double, sla_status string, "
    "chunk_count int, qa_segments int, qa_warning string, section_counts map<string,int>, pyannote_speakers array<string>, "
    f"dropped_segments array<{DROPPED}>, chunk_metrics array<{CHUNK}>, _corrupt_record string"
)
SUBMISSIONS = (
    "cik string, ticker string, filings struct<recent:struct<form:array<string>,accessionNumber:array<string>,"
    "filingDate:array<string>,primaryDocument:array<string>,items:array<string>,acceptanceDateTime:array<string>>>"
)
CACHED_PAGE = "status_code int, text string"
