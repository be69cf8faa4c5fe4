"""Types of the landed documents and of the stored tables."""

from pyspark.sql import types as T

S, A = T.StringType(), T.ArrayType(T.StringType())


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


step = struct(
    type=S, name=S, label=S, optional=T.BooleanType(), tool_id=S, content_id=S, input_connections=T.MapType(S, S)
)
workflow_doc = T.StructType(
    [T.StructField(n, S) for n in ("uuid", "name", "version", "description")]
    + [T.StructField("tags", A), T.StructField("format-version", S), T.StructField("steps", T.MapType(S, step))]
)
hub_entry = struct(url=S, description=S, versions=T.ArrayType(struct(descriptor_type=A)))
repo_listing = struct(name=S, remote_repository_url=S)
app_index = struct(name=S)
install_info = struct(owner=S, repo=S, revision=S, info=T.ArrayType(struct(remote_repository_url=S)))
git_tree = struct(repo_owner=S, repo=S, branch=S, tree=T.ArrayType(struct(path=S, type=S)))
descriptor = T.StructType(
    [T.StructField("name", S), T.StructField("tool-version", S), T.StructField("description", S), T.StructField("schema-version", S)]
    + [T.StructField("inputs", T.ArrayType(struct(type=S, description=S)))]
    + [T.StructField("output-files", T.ArrayType(struct(description=S)))]
)
parameter = struct(name=S, tag=S, type=S, format=S, label=S)
tool_xml = struct(
    id=S, name=S, version=S, description=S, help=S, inputs=T.ArrayType(parameter), outputs=T.ArrayType(parameter), error=S
)
tokens = T.ArrayType(struct(name=S, value=S))
xml_head = struct(imports=A, tokens=tokens, error=S)
sidecar = struct(owner=S, description=S, long_description=S, categories=A)
publish_result = struct(success=T.BooleanType(), status=T.IntegerType(), response=S, error=S)
harvest_errors = struct(stage=S, key=S, reason=S)

#: The registry table as it first was, and the columns that two migrations added.
tool_generic_v1 = struct(
    id=S, uri=S, name=S, description=S, version=S, archetype=S, input_file_formats=A, output_file_formats=A,
    location=S, raw_metadata=S, metadata_schema=S, metadata_type=S, metadata_version=S, created_by=S,
)
migrations = [
    struct(input_file_descriptions=A, output_file_descriptions=A),
    struct(keywords=A, tags=A, license=S),
]
tool_generic = T.StructType([*tool_generic_v1.fields, *(f for m in migrations for f in m.fields)])
tool_harvest = struct(
    url=S, status=S, error_code=S, source_type=S, artifact_type=S, stored_id=S, stored_table=S,
    created_at=T.TimestampType(), updated_at=T.TimestampType(),
)
artifact = struct(id=S, name=S, version=S, archetype=S, location=S, raw_metadata=S, metadata_type=S, metadata_version=S)
contract = struct(id=S, description=S, contract_version=S)
implementation = struct(contract_id=S, artifact_id=S)
contract_input = struct(contract_id=S, name=S, role=S, input_kind=S, type=S, description=S, encoding_formats=A)
contract_output = struct(contract_id=S, name=S, type=S, description=S, encoding_formats=A)

#: Archetypes, metadata types and ledger states.
GALAXY_WORKFLOW, VIP_APP, SHED_TOOL = "galaxy_workflow", "vip_app_boutique", "galaxy_shed_tool"
WORKFLOW_METADATA, DESCRIPTOR_METADATA = "a_galaxy_workflow", "boutique_descriptor"
PENDING, PROCESSED, COMPLETED, ERROR = "pending", "processed", "completed", "error"
