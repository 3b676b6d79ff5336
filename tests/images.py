"""Small JPEG trees, drawn and encoded by the JVM; none is stored."""

from __future__ import annotations

from pathlib import Path

LABELS = ["Apple Red 1", "Kiwi", "Plum+2 [x]"]


def draw_image(spark, file: Path, red: int, green: int, blue: int, *, side=100, grey=False):
    jvm = spark.sparkContext._jvm
    buffered = jvm.java.awt.image.BufferedImage
    kind = buffered.TYPE_BYTE_GRAY if grey else buffered.TYPE_INT_RGB
    image = buffered(side, side, kind)
    graphics = image.createGraphics()
    graphics.setColor(jvm.java.awt.Color(red, green, blue))
    graphics.fillRect(0, 0, side, side)
    graphics.dispose()
    file.parent.mkdir(parents=True, exist_ok=True)
    jvm.javax.imageio.ImageIO.write(image, "jpg", jvm.java.io.File(str(file)))


def draw_tree(spark, root: Path, per_label: int = 4) -> Path:
    """``per_label`` images in each class, one text file and one corrupt image."""
    for i, label in enumerate(LABELS):
        for j in range(per_label):
            draw_image(spark, root / label / f"{j}_100.jpg", 60 * i + 20, 200 - 40 * j, 128)
    (root / LABELS[0] / "notes.txt").write_text("not an image")
    (root / LABELS[1] / "broken.jpg").write_bytes(b"\xff\xd8 not really")
    return root
