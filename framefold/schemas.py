"""DDL of the landed documents and of the tables derived from them."""

CATALOGUE_A_BODY = """
query struct<pages: map<string, struct<
  title: string,
  imageinfo: array<struct<url: string, size: bigint, mime: string,
                          extmetadata: map<string, struct<value: string>>>>,
  categories: array<struct<title: string>>>>>
"""

# Renditions are a map so that "key present" differs from "value empty".
CATALOGUE_B_BODY = """
hits array<struct<id: bigint, tags: string, user: string, duration: double,
                  videos: map<string, struct<url: string, size: bigint>>>>
"""

DETECTION_BODY = """
JobStatus string,
StatusMessage string,
VideoMetadata struct<DurationMillis: bigint>,
Labels array<struct<Timestamp: bigint,
                    Label: struct<Name: string, Confidence: double, Instances: array<variant>>>>,
ModerationLabels array<variant>
"""

# What a summary needs of a response: the parser skips times and instances.
DETECTION_FACTS = """
JobStatus string,
StatusMessage string,
VideoMetadata struct<DurationMillis: bigint>,
Labels array<struct<Label: struct<Name: string, Confidence: double>>>,
ModerationLabels array<variant>
"""

CANDIDATE = """
source string, source_id string, title string, url string, size bigint, mime string,
author string, license string, description string, duration double
"""

ASSET = """
source string, title string, file_url string, license string, author string,
description string, duration double, file_size bigint, s3_key string,
ingested_at string, source_id string
"""

INDEX = """
id string, media_type string, campaign string, s3_key string, processed_key string,
ingested_at string, processed_at string, metadata string, ttl bigint,
source string, source_id string
"""

EXECUTION_INPUT = "campaign string, batch_size_video bigint"

EXECUTION_OUTPUT = """
ingested_count bigint,
source_counts variant,
metadata array<variant>,
metadata_by_source map<string, array<variant>>,
rekognition struct<jobs: array<variant>>,
finalization struct<processed_count: bigint, results: array<variant>>,
indexing struct<indexed_count: bigint>
"""

# One raw history event; the detail object sits under a key named after its type.
_STATE = "struct<name: string, input: string, seconds: double>"
_FAILURE = "struct<error: string, cause: string>"
_OUTPUT = "struct<output: string>"
_ITERATION = "struct<index: bigint, error: string, cause: string>"
HISTORY_EVENT = f"""
id bigint, type string, timestamp string,
stateEnteredEventDetails {_STATE},
stateExitedEventDetails struct<name: string>,
mapStateEnteredEventDetails {_STATE},
waitStateEnteredEventDetails {_STATE},
waitStateExitedEventDetails struct<name: string>,
lambdaFunctionScheduledEventDetails struct<resource: string>,
taskScheduledEventDetails struct<resource: string>,
lambdaFunctionSucceededEventDetails {_OUTPUT},
taskSucceededEventDetails {_OUTPUT},
mapStateSucceededEventDetails {_OUTPUT},
lambdaFunctionFailedEventDetails {_FAILURE},
taskFailedEventDetails {_FAILURE},
executionFailedEventDetails {_FAILURE},
mapIterationStartedEventDetails {_ITERATION},
mapIterationSucceededEventDetails {_ITERATION},
mapIterationFailedEventDetails {_ITERATION}
"""

DETECTION_STATUS = "JobStatus string, StatusMessage string"
