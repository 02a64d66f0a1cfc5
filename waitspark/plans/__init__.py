from waitspark.plans.charts import chart_tables
from waitspark.plans.processed import Processed, build_processed, enrich, prepare_weather
from waitspark.plans.training import Comparison, train_and_compare
from waitspark.plans.weather import load_weather, weather_readings

__all__ = [
    "Comparison",
    "Processed",
    "build_processed",
    "chart_tables",
    "enrich",
    "load_weather",
    "prepare_weather",
    "train_and_compare",
    "weather_readings",
]
