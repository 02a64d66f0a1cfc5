from waitspark.streaming.weather import stream_weather

__all__ = ["stream_weather"]
