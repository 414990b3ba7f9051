"""Models (staging, marts, views) and the analytical queries over them."""
