"""Views and landed inputs."""
