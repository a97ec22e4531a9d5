"""The pipeline: raw text -> staging -> participants -> career -> marts."""
