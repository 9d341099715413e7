from .sync import sync_stream, publish_window
