"""Readers and writers of annotation documents, predictions and metrics."""

from .documents import load_predictions, load_track_predictions, read_annotation_collection, read_coco, read_image_phrases, read_video_annotations
from .metrics import read_dataset_stats, read_detailed, read_last_metrics, write_detailed, write_image_metrics, write_metrics, write_predictions, write_summary
from .text import read_detection_text

__all__ = ["load_predictions", "load_track_predictions", "read_annotation_collection", "read_coco", "read_dataset_stats", "read_detailed", "read_detection_text", "read_image_phrases", "read_last_metrics", "read_video_annotations", "write_detailed", "write_image_metrics", "write_metrics", "write_predictions", "write_summary"]
