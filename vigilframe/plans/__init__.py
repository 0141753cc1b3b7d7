"""The tables of the pipeline, composed from sources and operators."""
