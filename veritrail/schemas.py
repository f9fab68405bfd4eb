"""Explicit schemas: fields that are null in every sampled row must not be inferred away."""

RETRIEVAL_LOG = "record_id string, retrieved_at string, url string, final_url string, provenance string, source string, http_status int, content_type string, content_length bigint, sha256 string, object_path string, error string, parent_url string, depth int"
LEDGER = "url string, previous_sha256 string, current_sha256 string, first_seen string, last_seen string, http_status int, change_type string"
URL_INVENTORY = "url string, host string, first_discovered string, last_confirmed string, discovered_via string, document_number string, publication_date string, title string, document_type string"
RECOVERY_LINK = "id string, original_url string, alternative_url string, relation string, sha256 string, created_at string, seq bigint"
ENTITY = "entity_id string, legal_name string, jurisdiction string, entity_type string, identity_basis string, merged_from array<string>, merge_basis array<string>"
PERSON = "person_id string, normalized_name string, name_variants array<string>, identity_basis string, merged_from array<string>, merge_basis array<string>"
EDGE = "subject_id string, assertion string, object_id string, ownership_percent double, evidence_class string, confidence double, evidentiary_posture string, predicate_raw string, source_id string, source_url string, source_date string, source_sha256 string, source_locator string"
