"""Fixed values of the landed data formats and of the result contract."""

# --- fixed values: catalogue names, licence text, prefixes -------------------
CATALOGUE_A = "wikimedia"
CATALOGUE_B = "pixabay"
SOURCES = ("wikimedia", "pixabay")
RETIRED_SOURCES = ("internetarchive",)
LICENCE_PREFIX = "Category:CC"
CATALOGUE_B_LICENCE = "Pixabay License (Free for commercial use)"
MIME_PREFIX = "video/"
DEFAULT_MIME = "video/mp4"
RENDITIONS = ("medium", "small", "large")
PREDEFINED_CAMPAIGNS = ("nature", "tech", "travel", "animals", "landscape")
RAW_ROOT = "media-raw"
PROCESSED_ROOT = "media-processed"
PROCESSED_SUFFIX = "_labels.json"
TITLE_LIMIT = 100
BATCH_TS_FORMAT = "yyyyMMdd_HHmmss"
BOTH_SOURCES_TEXT = "both (wikimedia + pixabay)"
SUBJECT_PREFIX = "Media Pipeline"

# --- fixed values: workflow event types, state names, status words -----------
MAP_STATE = "ProcessRekognitionJobs"
WAIT_STATE = "WaitForJob"
STATE_NAMES = {
    "IngestVideo": "Ingest Videos",
    "StartRekognitionJobs": "Start Rekognition Jobs",
    "ProcessRekognitionJobs": "Process Rekognition Jobs (Map State)",
    "WaitForJob": "Wait for Job",
    "CheckJobStatus": "Check Job Status",
    "JobComplete?": "Check if Job Complete",
    "FinalizeResults": "Finalize Results",
    "IndexVideo": "Index Video",
}
UNKNOWN_ERROR = "Unknown error"
EXECUTION_STEPS = ("Execution Started", "Execution Completed", "Execution Failed")
LAMBDA_TEXT = "Lambda: "
RESOURCE_TEXT = "Resource: "
STATE_TEXT = "State: "
MAP_TEXT = "Map State: Processing %d job(s)"
MAP_LIST_TEXT = "Map State: Processing multiple items"
WAIT_STEP = "Wait %ss"
WAIT_DETAILS = "Waiting %s seconds"
LAST_ORDER = 9999
KNOWN_EXECUTION_STATUSES = ("SUCCEEDED", "FAILED", "RUNNING", "TIMED_OUT", "ABORTED")
STEP_PREFIXES = {"SUCCEEDED": "[SUCCESS]", "FAILED": "[FAILED]", "RUNNING": "[RUNNING]"}
STEP_PREFIX_OTHER = "[PENDING]"
TERMINAL_JOB_STATUSES = ("SUCCEEDED", "FAILED")
