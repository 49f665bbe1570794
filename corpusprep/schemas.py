"""Schemas and contract versions of everything that is read or written."""

from __future__ import annotations

# fixed values: contract versions
JOB_VERSION = "1.2.0"
CHAPTER_METADATA_VERSION = "1.3.0"
CHUNK_JOB_VERSION = "1.0.0"
CHUNK_ARTIFACT_VERSION = "2.0.0"
MANIFEST_VERSION = 1
IDENTITY_VERSION = 1
SEED_ARTIFACT_VERSION = 1
AUDIT_VERSION = "1.0.0"
# end of fixed values

REFERENCE = "struct<backend:string,path:string,bucket:string,key:string,url:string>"
IDENTITY = "struct<algorithm:string,namespace:string,identity_contract_version:int,normalization:string,normalized_content_sha256:string,content_key:string>"
CHAPTER_TEXT = "category_code string, subject_code string, language string, chapter_no int, text string"
SPAN = "struct<text:string,start_char:int,end_char:int,source_index:int>"
CHUNK = "struct<index:int,text:string,sentence_count:int,char_count:int,estimated_token_count:int,start_sentence:int,end_sentence:int,start_char:int,end_char:int,chunk_text_sha256:string>"
MANIFEST = (
    "schema_version int, identity_contract_version int, subject struct<category_code:string,subject_code:string,language:string>, "
    f"chapters array<struct<generated_chapter_number:string,content_key:string,normalized_content_sha256:string,metadata_artifact:{REFERENCE},text_artifact:{REFERENCE}>>"
)
METADATA = (
    "document struct<category_code:string,subject_code:string,title_slug:string,chapter_number:string,version:string,language:string>, "
    f"storage struct<artifacts:struct<text:{REFERENCE},metadata:{REFERENCE}>>, "
    "integrity struct<artifacts:struct<text:struct<algorithm:string,encoding:string,line_endings:string,scope:string,value:string>>>, "
    f"content_identity {IDENTITY}, files struct<text_filename:string,metadata_filename:string>, automated_tags array<string>"
)
ISSUE = "severity string, row_number long, column string, message string"

# fixed values: headers of the tabular sources, in their order
GLOSSARY_HEADER = ("Sr No", "Term Code", "Term", "Definition")
CATEGORY_HEADER = ("code", "legacy_code", "is_active", "sort_order", "desired_status", "name_en", "description_en", "name_hi-IN", "description_hi-IN")
SUBJECT_HEADER = ("code", "legacy_code", "is_active", "sort_order", "category_code", "desired_status", "name_en", "description_en", "name_hi-IN", "description_hi-IN", "from_date", "to_date", "prabodhan_count")
# end of fixed values
