"""The bucket and session operators over streams."""
