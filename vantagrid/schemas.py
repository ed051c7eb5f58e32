"""Explicit schemas of the tables the engine keeps and the documents it reads."""

# Field names and types of the published documents.
BOX = "struct<class_id:int,x:int,y:int,w:int,h:int,mask_area:int,fill_ratio:double,components:int,contrast:double>"
ANNOTATION = f"frame_index int, normal string, width int, height int, boxes array<{BOX}>"
FLAG = "struct<frame_index:int,reason:string>"
QC_REPORT = (
    "run_id string, frames long, empty_frames long, total_boxes long, box_area_min int, box_area_max int, "
    f"fill_ratio_min double, fill_ratio_max double, contrast_min double, contrast_max double, contrast_unmeasured long, flags array<{FLAG}>"
)
RUN_FIELDS = ("run_id", "captured_at", "frame_count", "ue_map", "drone_model", "camera_sequence", "randomization", "generator", "seed", "schema_version")
BOX_FIELDS = ("class_id", "x", "y", "w", "h", "mask_area", "fill_ratio", "components", "contrast")
FRAME_FIELDS = ("frame_index", "normal", "width", "height", "boxes")
SCHEMA_VERSION = 1
MANIFEST = "manifest.json"
PROVENANCE_SUFFIX = ".provenance.json"
