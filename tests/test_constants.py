"""Fixed values, written out here a second time: engine and oracle read the same module, so
a wrong entry there would pass in both."""

from __future__ import annotations

from gavlake import schemas as S
from gavlake.functions import version as V


def test_words_codes_and_texts():
    assert S.AVAILABILITY_CODES == {"NOT_PRESENT": 0, "PRESENT": 1, "NOT_AVAILABLE": 2}
    assert sorted(S.UNSTABLE_VERSION_WORDS) == [
        "alpha", "beta", "build", "cr", "custom", "dev", "draft", "incubating", "m", "nightly", "post", "pre",
        "preview", "rc", "snapshot", "sp"]
    assert S.DOWNLOAD_COMMAND_PREFIX == "mvn dependency:copy -U -DoutputDirectory=. -Dartifact="
    assert (S.UINFO_MAX_LEN, S.SHA1_MAX_LEN, S.LOCATION_TYPE, S.BINARY_CLASSIFIER) == (250, 40, 2, "bin")
    assert S.EXTENSION_FIXES == (("org.apache.tomcat", "tomcat", "zip.sha512", "zip"),)
    assert S.DEFAULT_EXTENSIONS == ("jar", "zip")


def test_limits():
    assert set(S.COLUMN_LIMITS) == {
        ("artifactinfo", "uinfo_md5", None, True), ("artifactinfo", "version_seq", None, True),
        ("artifactinfo", "uinfo", 254, True), ("gav", "uinfo_md5", None, True), ("gav", "version_seq", None, True),
        ("gav", "uinfo", 254, True), ("gav", "group_id", 254, True), ("gav", "artifact_id", 254, True),
        ("gav", "artifact_version", 128, True), ("gav", "sha1", 40, False), ("gav", "classifier", 128, False),
        ("gav", "file_extension", 254, False), ("gav", "packaging", 254, False), ("gav", "name", 1024, False)}


def test_version_key_values():
    assert (V.MAJOR_VERSION_MAX, V.YEAR_PREFIX_LEN, V.YEAR_FIRST_MAX) == (922, 10, 9223372036)
    assert (V.MINOR_DIGITS, V.INCREMENTAL_DIGITS, V.FOURTH_DIGITS) == (4, 6, 6)
    assert (V.YEAR_SECOND_DIGITS, V.YEAR_THIRD_DIGITS, V.INT_MAX) == (6, 3, 2147483647)


def test_record_keys():
    assert sorted(n for n, _ in S.RECORD_FIELDS) == [
        "artifactId", "attributes", "classifier", "context", "description", "fileExtension", "groupId",
        "javadocExists", "lastModified", "matchHighlights", "name", "packaging", "repository", "sha1",
        "signatureExists", "size", "sourcesExists", "version"]


def test_table_columns():
    assert S.ARTIFACTINFO.fieldNames() == [
        "uinfo_md5", "major_version", "version_seq", "uinfo_length", "classifier_length", "signature_exists",
        "sources_exists", "javadoc_exists", "uinfo", "json"]
    assert S.GA.fieldNames() == ["group_id", "artifact_id", "artifact_version_counter", "major_version_counter",
                                 "version_seq_max", "last_modified_max"]
