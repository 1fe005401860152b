"""The jobs: warehouse build, marts, exploration, quality and catalog."""
