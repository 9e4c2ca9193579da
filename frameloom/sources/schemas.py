"""Schemas of the inputs and outputs; nothing is inferred."""

DESCRIBED_OBJECTS = "images array<struct<id:bigint,file_name:string>>, categories array<struct<id:bigint,name:string>>, annotations array<struct<image_id:bigint,category_id:bigint>>"
SMALL_OBJECTS = "image string, bbox array<double>, ref string"
EXPRESSION = "sentence string, raw_sentence string, label map<string,array<bigint>>"
TRACKING = "language string, targets map<string,array<bigint>>"
MOTION = "videos map<string,struct<expressions:map<string,struct<exp:string>>,frames:array<string>>>"
TEMPLATE = "sample_id string, source string, sequence string, source_index int, source_image string, template_image string, bbox_xywh array<double>, crop_xyxy array<int>, original_size array<int>, context_scale double, output_size int, source_text string"
MESSAGES = "array<struct<role:string,content:string>>"
ROW = f"messages {MESSAGES}, images array<string>, videos array<array<string>>"
PREDICTION = f"index long, response string, predict string, prediction string, generated_text string, output string, answer string, reference string, label string, messages {MESSAGES}, dataset string, source string"
